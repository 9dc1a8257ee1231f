import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartcast.llm import repair, tokens
from cartcast.llm.common import documents, keyed_text

from .texts import NASTY, random_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("generation", [700_000, 20])
def test_units_equal_whole_texts(path, generation, monkeypatch):
    monkeypatch.setattr(tokens, "BYTE_GENERATION", generation)
    monkeypatch.setattr(tokens, "WORD_GENERATION", generation)
    lib, own = Tokenizer.from_file(path), tokens.UnitTokenizer(path)
    texts = NASTY + random_texts(300, 2) + [None] + ["plain words, and more.\nNext line; done" for _ in range(3)]
    for at in range(0, len(texts), 40):
        part = texts[at:at + 40]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(part)] == \
            [lib.encode(t or "", add_special_tokens=False).ids for t in part]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_with_marks_equal_the_library(path):
    """Words of any script before runs of marks, at the start and after breaks."""
    lib, own = Tokenizer.from_file(path), tokens.UnitTokenizer(path)
    words = ["tion", "Ciónll", "Êrévi", "x1", "it's", "don't,", "\u0130stanbul", "\u00aa", "2", "", "\u4e2d\u6587"]
    ends = ["", ",", "!?", "$$$", ".%%%", "'", "-x", "(a)", "_", "\u2026", "..a", "***,'s"]
    texts = [lead + w + e + tail for w in words for e in ends
             for lead, tail in (("", ""), ("a ", " b"), ("a\n", "\n" + w + e), (e + " ", "  " + w))]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == \
        [lib.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(8))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 80, 60)
    seq = rng.integers(0, (3, 50, 60_000)[seed % 3], counts.sum()).astype(np.uint32)
    if seed > 5:
        seq[:] = 7
    last = np.zeros(len(seq), bool)
    last[np.cumsum(counts) - 1] = True
    symbols, ends, rules = repair.compress(seq.copy(), last.copy(), rounds=5)
    lengths = repair.rule_lengths(rules)
    assert (repair.expand(symbols, rules, lengths) == seq).all()
    assert ends.sum() == len(counts) and len(symbols) <= len(seq)
    if seed % 3 == 0:
        assert len(symbols) < len(seq) / 2


def uses(symbols, ends):
    """Non-overlapping occurrences of every pair, documents apart."""
    count, free = Counter(), {}
    for i in np.flatnonzero(~ends[:-1]).tolist():
        pair = (int(symbols[i]), int(symbols[i + 1]))
        if free.get(pair, 0) <= i:
            count[pair] += 1
            free[pair] = i + 2
    return count


@pytest.mark.parametrize("slots", [repair.SLOT_BITS, 4])
@pytest.mark.parametrize("most", [repair.PAIRS_PER_ROUND, 3])
def test_no_frequent_pair_is_left(slots, most, monkeypatch):
    monkeypatch.setattr(repair, "SLOT_BITS", slots)
    rng = np.random.default_rng(slots + most)
    passage = rng.integers(0, 60_000, 200)
    for parts in ([passage] * 8,
                  [np.full(n, 7) for n in range(1, 120)],
                  [rng.integers(0, 6, n) for n in rng.integers(1, 90, 60)],
                  [np.concatenate([rng.integers(0, 300, 40), passage, np.full(9, 7)]) for _ in range(30)]):
        seq = np.concatenate(parts).astype(np.uint32)
        last = np.zeros(len(seq), bool)
        last[np.cumsum([len(p) for p in parts]) - 1] = True
        symbols, ends, rules = repair.compress(seq.copy(), last.copy(), most=most)
        assert (repair.expand(symbols, rules, repair.rule_lengths(rules)) == seq).all()
        assert ends.sum() == len(parts)
        assert max(uses(symbols, ends).values(), default=0) < repair.LEAST_USES
    symbols = repair.compress(np.tile(passage, 8).astype(np.uint32), np.arange(1, 1601) % 200 == 0)[0]
    assert len(symbols) == 8  # every copy is one symbol


def test_files_decode_to_library_ids(llm):
    docs = documents(llm, "/root/testdata/sf0.001")
    files = repair.token_files(docs, BYTES, shard_tokens=5000)
    got = {r["doc_id"]: tuple(r)[1:] for r in repair.read_documents(files).collect()}
    at, want = 0, {}
    for r in sorted(keyed_text(docs).collect()):
        ids = library(BYTES, r["text"]) + [0]
        want[r["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    row = files.first().asDict()
    for k in (0, len(row["doc_ids"]) - 1):
        text = docs.filter(docs.doc_id == row["doc_ids"][k]).first()["text"]
        assert repair.decode_document(row, k).tolist() == library(BYTES, text) + [0]


def test_nulls_repeats_and_empty(make):
    frame = make([(5, None), (3, "b c"), (3, "b c"), (None, "a"), (4, "")])
    rows = sorted([tuple(r) for r in repair.read_documents(repair.token_files(frame, BYTES)).collect()],
                  key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, 3, 3, 4, 5]
    assert [r[2] for r in rows] == [2, 3, 3, 1, 1] and [r[1] for r in rows] == [0, 2, 5, 8, 9]
    assert repair.read_documents(repair.token_files(frame.limit(0), BYTES)).count() == 0


def test_a_very_long_document_reads_back(make):
    texts = ["Several words, again.\n" * 20_000, "xy" * 8000, "end"]
    rows = {r["doc_id"]: r for r in repair.read_documents(repair.token_files(make(list(enumerate(texts))), BYTES, shard_tokens=5000)).collect()}
    for i, t in enumerate(texts):
        ids = library(BYTES, t) + [0]
        assert (rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
