import hashlib
import random
from collections import Counter

from cartcast.llm import sketch
from cartcast.llm.sketch import Sketch, Versions


def test_subtraction_and_peeling_recover_differences():
    rng = random.Random(1)
    for shared, left, right in ((0, 0, 0), (50, 1, 0), (50, 0, 2), (200, 30, 40), (0, 500, 3)):
        common = [rng.getrandbits(64) for _ in range(shared)]
        a, b = [rng.getrandbits(64) for _ in range(left)], [rng.getrandbits(64) for _ in range(right)]
        x, y = Versions(""), Versions("")
        x.digests, y.digests = common + a, common + b
        x.levels, y.levels = [Sketch(x.digests)], [Sketch(y.digests)]
        here, there, _ = x.compare(y)
        assert sorted(here) == sorted(a) and sorted(there) == sorted(b)


def test_small_tables_fail_and_larger_ones_succeed():
    a = Versions("\n".join(f"line {i}" for i in range(300)))
    b = Versions("\n".join(f"other {i}" for i in range(300)))
    assert a.level(0).differences(b.level(0)) is None
    here, there, level = a.compare(b)
    assert level > 0 and len(here) == len(there) == 300


def test_repeated_paragraphs_are_a_multiset():
    a, b = Versions("x\nx\ny"), Versions("x\ny")
    assert a.likeness(b) == 2 / 3 and a.likeness(a) == 1.0


def test_equal_digests_end_with_the_exact_difference():
    a, b = Versions("x"), Versions("y")
    a.digests, a.levels = [5, 5], [Sketch([5, 5])]
    assert a.compare(b)[0] == [5, 5]


def test_edits_in_texts_without_sentence_ends():
    rng = random.Random(4)
    word = [f"w{i}" for i in range(300)]
    texts = {"words": " ".join(rng.choices(word, k=6000)),
             "table": ",".join(str(rng.randrange(10 ** 6)) for _ in range(3000)),
             "script": "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(8000)),
             "short": " ".join(rng.choices(word, k=20)),
             "run": "x" * 20_000}
    other = " ".join(rng.choices(word, k=8000))
    for name, text in texts.items():
        own = Versions(text)
        assert own.likeness(Versions(sketch.edited_text(text, other))) > (0.2 if len(text) > 200 else 0), name
        if name != "run":
            at = len(text) // 2
            edited = text[:at] + "qqq" + text[at + 1:]
            lost = len(own.compare(Versions(edited))[0])
            assert lost <= max(8, len(own.digests) // 10), name
    assert max(map(len, sketch.blocks(texts["words"] + texts["run"]))) <= sketch.MOST
    assert b"".join(sketch.blocks(texts["script"])) == texts["script"].encode()


def test_tables_filled_by_arrays_are_the_same():
    rng = random.Random(5)
    digests = [rng.getrandbits(64) for _ in range(100)]
    for level in (0, 3):
        one = Sketch([], level)
        for d in digests:
            for at in sketch._cells(d, (sketch.CELLS << level) // sketch.HASHES):
                one.count[at] += 1
                one.keys[at] ^= d
                one.checks[at] ^= sketch._check(d)
        assert one.data() == Sketch(digests, level).data()


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = []
    for i, (d, t) in enumerate(rows):
        t, n = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + n[:half]
        da, de, dn = (Counter(sketch.paragraph_digests(x)) for x in (t, new, n))

        def like(p, q):
            return (p & q).total() / (p | q).total() if p | q else 1.0
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), round(like(da, de), 9), round(like(da, dn), 9)))
    return out


def test_query_equals_brute_force(make, llm):
    rng = random.Random(2)
    words = ["alpha", "béta", "gamma.", "delta", "\n", "eps!"]
    rows = [(i * 7 % 101, " ".join(rng.choices(words, k=rng.randrange(0, 200)))) for i in range(60)]
    rows = list({d: (d, t) for d, t in rows}.values()) + [(200, None), (201, ""), (202, "x" * 200_000), (None, "né\nant")]
    got = sketch.document_fingerprints(make(rows)).collect()
    assert len(got) == len(rows)
    have = sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
                    round(r["near_next"], 9)) for r in got], key=str)
    assert have == sorted(brute(rows), key=str)
    same = sketch.document_fingerprints(make([(1, "a\nb"), (2, "a\nb"), (2, "a\nb")])).collect()
    assert len({r["fingerprint"] for r in same}) == 1 and {r["near_next"] for r in same} == {1.0}
    assert sketch.document_fingerprints(make(rows).limit(0)).count() == 0
    assert sketch.document_fingerprints(make([(5, "solo\ntext")])).first()["near_next"] == 1.0
