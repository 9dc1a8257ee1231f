import random
import re
from collections import Counter

from cartcast.llm import quality


def brute(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    marked = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\\x20\\x09-\\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(marked))


def test_counts_equal_brute_force():
    rng = random.Random(1)
    pool = ["a", "b", "c d", "\n", "\n", "x y z", "###", "é|", "\x85q", "\t"]
    for _ in range(300):
        text = " ".join(rng.choices(pool, k=rng.randrange(0, 40)))
        assert quality.measure(text)[:5] == brute(text)
    assert quality.measure(None)[:5] == (0, 0, 0, 0, 0)


def test_votes_round_trip():
    for code in (0, 1, 12345, 3 ** 10 - 1):
        assert quality.pattern(quality.unpack(code)) == code


def test_em_separates_planted_classes():
    rng = random.Random(2)
    counts, truth = Counter(), {}
    for _ in range(5000):
        good = rng.random() < 0.85
        votes = [-1 if rng.random() < 0.1 else int(rng.random() < (0.97 if good else 0.45)) for _ in range(10)]
        code = quality.pattern(votes)
        counts[code] += 1
        truth.setdefault(code, Counter())[good] += 1
    posterior = quality.fit_votes(counts)
    right = sum(n for c, t in truth.items() for g, n in t.items() if (posterior[c] >= 0.5) == g)
    assert right / 5000 > 0.97
    assert quality.fit_votes({}) == {}


def test_query(make):
    rng = random.Random(3)
    words = [f"wo{c}d{d}" for c in "abcdefgh" for d in "ijklmnop"]
    clean = [" ".join(rng.choices(words, k=120)) for _ in range(40)]
    junk = [" ".join(w.upper() + "$$$" for w in t.split()) for t in clean[:8]]
    rows = [(i, t) for i, t in enumerate(clean + junk)] + [(90, None), (91, ""), (92, "a b c " * 50), (92, "short"), (None, clean[0])]
    out = quality.quality_rules(make(rows)).collect()
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["n_words"]): r for r in out}
    assert all(by[i, 120]["kept"] for i in range(40)) and not any(by[40 + i, 120]["kept"] for i in range(8))
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality_rules(make(rows).limit(0)).count() == 0


def test_a_very_long_text_is_measured_whole(make):
    text = "alpha beta gamma delta\n" * 100_000 + "omega"
    r = quality.quality_rules(make([(1, text), (1, text), (2, "q " * 60)])).collect()
    assert len(r) == 3
    for x in r:
        if x["doc_id"] == 1:
            assert (x["n_words"], x["n_dup_lines"], x["n_repeat_words"]) == (400_001, 99_999, 400_000)
            assert x["base_failed"] and not x["kept"]
