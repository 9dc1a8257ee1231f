import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cartcast.llm import bpe
from cartcast.llm.common import documents, keyed_text

from .texts import NASTY, random_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def want(texts):
    lib = Tokenizer.from_file(PATH)
    out = []
    for t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        out.append((np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    return out


def test_equals_library_on_unusual_texts():
    texts = NASTY + random_texts(300) + [None]
    assert bpe.WordBpe(PATH).encode_batch(texts) == want(texts)


def test_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    coder = bpe.WordBpe(PATH)
    texts = [f"some words {i} and others{i % 3}" for i in range(50)]
    for t, w in zip(texts, want(texts)):
        assert coder.encode_batch([t]) == [w]


def test_lower_rank_that_appears_goes_first():
    coder = bpe.WordBpe(PATH)
    words = ["abcabcabc", "aaaaaaa", "lololololol", "thethethe", "ississippi"]
    lib = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode_words(words)] == \
        [lib.encode(w, add_special_tokens=False).ids for w in words]


def test_query_equals_library(llm):
    docs = documents(llm, "/root/testdata/sf0.001")
    rows = keyed_text(docs).collect()
    lib = dict(zip([r["doc_id"] for r in rows], want([r["text"] for r in rows])))
    got = bpe.bpe_digests(docs, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, text = lib[r["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == \
            (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_nulls_repeats_and_empty(make):
    frame = make([(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b")])
    rows = bpe.encode_documents(frame, PATH).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 2, 2, 2]
    assert bpe.bpe_digests(frame.limit(0), PATH).count() == 0


def test_very_long_texts_and_words(make):
    texts = ["several plain words, again " * 30_000, "abc" * 20_000, "é" * 30_000]
    got = {r["doc_id"]: r for r in bpe.bpe_digests(make(list(enumerate(texts))), PATH).collect()}
    for i, (ids, text) in enumerate(want(texts)):
        assert (got[i]["ids_sha256"], got[i]["decoded_sha256"]) == \
            (hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_cache_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 10_000)
    coder = bpe.WordBpe(PATH)
    for i in range(30):
        texts = [f"long{i}" + "q" * 900, "short"]
        assert coder.encode_batch(texts) == want(texts)
        assert sum(map(len, coder.cache)) + sum(map(len, coder.cache.values())) < 20_000
