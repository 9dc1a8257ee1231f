import hashlib
import random

import numpy as np
import pyarrow as pa

from cartcast.llm import suffixes as S


def brute(rows):
    """Result rows by the definition."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        key = S.LOWEST if d is None else d
        for i in range(len(b) - 49):
            s = b[i:i + 50]
            first[s] = min(first.get(s, key), key)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        key = S.LOWEST if d is None else d
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < key:
                gone[i:i + 50] = b"\x01" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted([tuple(r)[:5] for r in frame.collect()], key=str)


def corpus(rng, n):
    words = ["the", "of", "anlyé", "tion", "ß", "x", "edsh", "a" * 9]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 40))))
        out.append((i * 3, "\n".join(parts)))
    return out


def test_two_stage_sort_orders_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n, symbols = int(rng.integers(1, 300)), int(rng.integers(1, 4))
        text = rng.integers(1, symbols + 1, n).astype(np.uint16)
        text[rng.random(n) < 0.05] = text[-1] = 0
        wanted = rng.random(n) < 0.7
        order = S.two_stage_sort(text, wanted, 20)
        padded = text.tolist() + [0] * 20
        heads = [padded[i:i + 20] for i in order]
        assert heads == sorted(heads) and sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        common = S.common_prefixes(order, S._words(text, 20), 20)
        for k in range(1, len(order)):
            same = next((j for j in range(20) if heads[k][j] != heads[k - 1][j]), 20)
            assert common[k] == same


def test_equals_brute_force(make):
    rng = random.Random(1)
    rows = corpus(rng, 60)
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (2, rows[5][1])]  # copies
    rows += [(1002, None), (1003, ""), (1004, "short"), (None, rows[7][1]), (None, rows[7][1])]
    rows += [(1005, "a" * 400), (1006, "b" + "a" * 130 + "c"), (1007, "é" * 90), (1005, "a" * 70 + rows[9][1])]
    want = brute(rows)
    frame = make(rows)
    assert rows_of(S.suffix_dedup(frame)) == want
    # many small blocks and buckets, segments shorter than a text
    assert rows_of(S.suffix_dedup(frame, block_bytes=300, bucket_bytes=700)) == want
    # every repeated anchor is hot: routed by its right and its left bytes
    assert rows_of(S.suffix_dedup(frame, block_bytes=300, bucket_bytes=700, hot_blocks=0)) == want
    # blocks reach the buckets by way of gatherers
    for hot in (0, S.HOT_BLOCKS):
        assert rows_of(S.suffix_dedup(frame, block_bytes=300, bucket_bytes=700, hot_blocks=hot, fan_out=2)) == want


def test_sent_rows_do_not_grow_with_the_buckets():
    rng = np.random.default_rng(7)
    table = pa.table({"doc_id": list(range(50)), "block": [0] * 50,
                      "text": ["".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(50)]})

    def sent(n_buckets):
        coarse = n_buckets if n_buckets <= S.FAN_OUT else S.math.isqrt(n_buckets - 1) + 1
        out = S.send_anchors(table, coarse, -(-n_buckets // coarse))
        assert sum(out["n"].to_pylist()) == hashes
        return out.num_rows, sum(len(b) for b in out["hashes"].to_pylist())
    hashes = len(np.unique(S._block(table).anchors()[1]))
    few, many = sent(32), sent(1 << 20)
    assert many[0] <= 1024 and many[1] < 1.3 * few[1]


def test_a_shared_surrounding_is_one_entry_per_gatherer():
    rng = np.random.default_rng(8)
    rows = rng.integers(97, 123, (1, S.WIDTH)).astype(np.uint8)
    full = np.full(1, S.LEFT, np.uint8), np.full(1, S.LENGTH, np.uint8)
    key = S._gram_hashes(rows[:, S.LEFT:S.LEFT + S.GRAM])[:, 0]
    c = int(S.bucket_of(key, 12)[0]) // 4
    sent = [{**S._routed_row(c, 0, b, rows, *full, np.array([100 - b])), "gatherer": 5} for b in range(15, 18)]
    table = pa.Table.from_pylist(sent, schema=S.ROUTED.append(pa.field("gatherer", pa.int64())))
    out = S.gather_surroundings(table, 3, 4).to_pylist()
    assert [(r["bucket"], r["block"], r["n"]) for r in out] == [(int(S.bucket_of(key, 12)[0]), 15 + c, 1)]
    assert S._unpack(out[0]["least"], np.int64, 1).tolist() == [83]
    # all but the smallest document lose every window, whatever the bucket says
    back = S.return_marks(table, S.MARKED.empty_table()).to_pylist()
    assert [r["block"] for r in back] == [15, 16]
    assert all(S._unpack(r["masks"], np.uint32, 1)[0] == S.ALL for r in back)


def test_equal_rows_are_counted_first(make, monkeypatch):
    def batches():
        for part in range(6):
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": d, "text": t, "key": k} for d, t, k in
                 [(1, "hot", 7), (1, "hot", 7), (None, None, 8), (2, "other", 7), (3 + part, "one", 9 + part)] * (1 + part % 2)])
    monkeypatch.setattr(S, "by_bytes", lambda it: (pa.Table.from_batches([b]) for b in it))
    for hold in (0, 1 << 20):
        got = [r for b in S.collapse(batches(), hold) for r in b.to_pylist()]
        total = {}
        for r in got:
            total[r["doc_id"], r["text"]] = total.get((r["doc_id"], r["text"]), 0) + r["copies"]
        assert total == {(1, "hot"): 18, (None, None): 9, (2, "other"): 9, **{(3 + i, "one"): 1 + i % 2 for i in range(6)}}
    assert sum(r["text"] == "hot" for r in got) == 1  # held over the whole task
    monkeypatch.undo()
    rows = [(4, "x" * 70)] * 40 + [(None, "y" * 60)] * 30 + [(5, "x" * 60), (4, "y" * 50 + "z")]
    assert rows_of(S.suffix_dedup(make(rows))) == brute(rows)


def test_parts_of_a_bucket(monkeypatch):
    rng = np.random.default_rng(5)
    rows = rng.integers(97, 99, (300, S.WIDTH)).astype(np.uint8)
    rows[100:200, 20:75] = rows[:100, 20:75]
    rows[200:] = rows[rng.integers(0, 100, 100)]
    rows = np.unique(rows, axis=0)
    full = np.full(len(rows), S.LEFT, np.uint8), np.full(len(rows), S.LENGTH, np.uint8)
    least = rng.permutation(len(rows))
    for side in range(3):
        whole = S.smallest_documents(rows, *full, least, side)
        monkeypatch.setattr(S, "TASK_WINDOWS", 7)
        assert (S.smallest_documents(rows, *full, least, side) == whole).all()
        monkeypatch.undo()


def test_segments(monkeypatch):
    rng = random.Random(2)
    texts = [t for _, t in corpus(rng, 20)]
    block = S.Block(list(range(20)), texts)
    whole = block.anchors()
    monkeypatch.setattr(S, "SEGMENT", 64)
    parts = block.anchors()
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_zero_bytes_and_equal_hashes(make, monkeypatch):
    text = "\x00" * 80 + "tail" + "\x00" * 20
    rows = [(1, text), (2, "\x00" * 60), (3, "q" + text)]
    assert rows_of(S.suffix_dedup(make(rows))) == brute(rows)
    rng = np.random.default_rng(3)
    r = rng.integers(0, 255, (6, S.WIDTH)).astype(np.uint8)
    r[3] = r[0]
    full = np.full(6, S.LEFT, np.uint8), np.full(6, S.LENGTH, np.uint8)
    pick, low, group = S._groups(r, *full, np.arange(6), np.zeros(6, np.uint64))
    assert len(pick) == 5 and group[0] == group[3] and low[group[3]] == 0


def test_empty_table_and_carried_columns(make):
    frame = make([(1, "x" * 60), (2, "x" * 60)])
    assert S.suffix_dedup(frame.limit(0)).count() == 0
    got = {r["doc_id"]: r for r in S.suffix_dedup(frame, with_text=True, carry=("lang", "source")).collect()}
    assert bytes(got[1]["kept"]) == b"x" * 60 and bytes(got[2]["kept"]) == b"" and got[2]["lang"] == "en"
