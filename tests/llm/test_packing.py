import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cartcast.llm import packing
from cartcast.llm.common import documents, keyed_text, saved

PATH = public_tokenizers.path("word_bpe_49k.json")


def gapless(rows, capacity=packing.CAPACITY):
    """rows of (sequence, offset, length): every sequence is filled in order."""
    bins = {}
    for s, o, n in rows:
        bins.setdefault(s, []).append((o, n))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def fewest(lengths, capacity):
    """Fewest bins by search (small inputs)."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        tried = set()
        for k, free in enumerate(bins):
            if free >= lengths[i] and free not in tried:
                tried.add(free)
                place(i + 1, bins[:k] + [free - lengths[i]] + bins[k + 1:])
        place(i + 1, bins + [capacity - lengths[i]])
    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def test_bounds_never_exceed_the_fewest_bins():
    rng = np.random.default_rng(1)
    tight = 0
    for _ in range(120):
        lengths = rng.integers(1, 25, rng.integers(1, 9))
        exact = fewest(lengths.tolist(), 24)
        bins, offsets = packing.best_fit_decreasing(lengths, 24)
        used = gapless(zip(bins.tolist(), offsets.tolist(), lengths.tolist()), 24)
        bound = packing.lower_bound(lengths, 24)
        assert bound <= exact <= used
        tight += bound == exact
    assert tight > 100
    assert packing.lower_bound(np.array([], np.int64)) == 0


def test_exchange_lowers_the_count(llm):
    rng = np.random.default_rng(2)
    lengths = rng.integers(600, 1100, 600).tolist()
    items = saved(llm.createDataFrame([(i, n) for i, n in enumerate(lengths)], "item long, length long"), "items")
    counts = []
    for turns in (0, 3, None):
        got = packing.best_fit_pack(items, per_task=20, exchanges=turns).collect()
        assert sorted((r["item"], r["length"]) for r in got) == list(enumerate(lengths))
        counts.append(gapless([(r["sequence_id"], r["offset"], r["length"]) for r in got]))
    assert max(counts[1:]) < counts[0]
    assert counts[2] >= packing.lower_bound(np.array(lengths))


def test_rounds_go_on_while_they_help(llm):
    """Lengths that leave gaps: rounds go past the fourth."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(600, 1100, 600).tolist()
    items = saved(llm.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "item long, length long"), "items")
    packed, notes = packing.pack_certified(items, per_task=20)
    rows, notes = packed.collect(), notes.collect()
    used = gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows])
    total = next(r for r in notes if r["turn"] == -1)
    assert (total["bins"], total["bound"]) == (used, packing.lower_bound(np.array(lengths)))
    assert sum(r["kept"] for r in notes if r["turn"] >= 0) == used
    assert all(r["bound"] <= r["bins"] for r in notes)
    assert max(r["turn"] for r in notes) >= 4
    none = packing.pack_certified(items, per_task=20, exchanges=0)[1].filter("turn = -1").first()
    assert used < none["bins"]


def test_pieces_equal_library(llm):
    docs = documents(llm, "/root/testdata/sf0.001")
    lib, want = Tokenizer.from_file(PATH), set()
    for r in keyed_text(docs).collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s:s + 2048]
            want.add((r["doc_id"], k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack_documents(docs, PATH).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    used = gapless([(r["sequence_id"], r["offset"], r["length"]) for r in got])
    assert used <= packing.lower_bound(np.array([r["length"] for r in got])) + 1


def test_nulls_repeats_long_and_empty(make):
    frame = make([(1, None), (1, ""), (None, "a"), (2, "word " * 10_000)])
    got = packing.pack_documents(frame, PATH).collect()
    assert sorted(r["length"] for r in got) == [1, 1, 2, 10_001 - 4 * 2048] + [2048] * 4
    gapless([(r["sequence_id"], r["offset"], r["length"]) for r in got])
    assert packing.pack_documents(frame.limit(0), PATH).count() == 0
