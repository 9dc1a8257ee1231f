import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cartcast.llm import wordshuffle
from cartcast.llm.common import documents, keyed_text

from .texts import NASTY, random_texts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
# letters of several Unicode versions, newer than some tables
NEWER = ["Ᲊᲊ a\U00010d40", "\U000105c0x\U00016d40 ࢏౜", "͸ \U0003fffd"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(docs):
    return wordshuffle.encode_documents(docs, PATH, public_tokenizers.PATTERN)


def ids_of(row):
    return np.frombuffer(row["ids"], "<u4").tolist()


def test_equals_library_on_unusual_texts(make, library):
    texts = NASTY + NEWER + random_texts(300) + ["ab" * 5000, "the " * 20000, "z" * 70000]
    got = {r["doc_id"]: ids_of(r) for r in encoded(make(list(enumerate(texts)))).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_long_words_merge_like_short_ones(monkeypatch):
    ranks = wordshuffle.Ranks(PATH)
    words = [b" interesting", b"abcabcabcabc", b"aaaaaaaaa", b"--------=====", "ünïcödé".encode()]
    want = [ranks._scan(w) for w in words]
    assert [ranks._agenda(w) for w in words] == want


def test_small_blocks_buckets_and_memory_change_nothing(make, library, monkeypatch):
    monkeypatch.setattr(wordshuffle, "REMEMBERED", 3)
    texts = random_texts(60, 5) + ["some words and other words"] * 20
    rows = make(list(enumerate(texts)))
    want = {i: library.encode_ordinary(t) for i, t in enumerate(texts)}
    for size, long_text in ((40, 10), (1 << 20, 1 << 20)):
        monkeypatch.setattr(wordshuffle, "BLOCK_BYTES", size)
        monkeypatch.setattr(wordshuffle, "LONG_TEXT", long_text)
        monkeypatch.setattr(wordshuffle, "GATHER_WORDS", 5)
        words, block = wordshuffle.Words(public_tokenizers.PATTERN), wordshuffle.Block("b", 3)
        for i, t in enumerate(texts):
            block.add(i, t, words)
        _, distinct, bucket, at = block.close()
        assert b"".join(distinct[i] for i in at).decode() == "".join(texts)
    got = {r["doc_id"]: ids_of(r) for r in encoded(rows).collect()}
    assert got == want


def test_a_frequent_word_travels_once_per_block(make):
    rows = make([(i, "hot word " * 500) for i in range(50)]).coalesce(2)
    sent = wordshuffle.sent_words(keyed_text(rows), public_tokenizers.PATTERN, 4).collect()
    assert len({r["block"] for r in sent}) == 2
    assert sum(len(wordshuffle.unpack(r["sizes"])) for r in sent) == 2 * 4   # "hot", " hot", " word", last " "


def test_nulls_repeats_very_long_and_empty(make):
    frame = make([(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b"), (3, "word " * 300_000)])
    rows = encoded(frame).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 2, 2, 2, 300_001]
    shown = {r["doc_id"]: bytes(r["decoded"]) for r in wordshuffle.decode_documents(encoded(frame), PATH).collect()}
    assert shown[2] == b"a b" and shown[3] == b"word " * 300_000 and shown[1] == b""
    assert encoded(frame.limit(0)).count() == 0


def test_query_equals_library(llm, library):
    docs = documents(llm, "/root/testdata/sf0.001")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = wordshuffle.op13_word_shuffle_bpe(llm, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
    assert len(got) == docs.count()
