import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cartcast.llm import alignment
from cartcast.llm.common import documents

from .texts import NASTY, random_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_level():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            table[chr(spare)] = b
            spare += 1
    return table


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte_level()


def tokens(tools, text):
    """Plain lists of (id, bytes) of both tokenizers, empty where they differ."""
    a, b, table = tools
    if not text:
        return [], []
    left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    same = b"".join(t for _, t in left) == want == b"".join(t for _, t in right)
    return (left, right) if same else ([], [])


def groups_of(left, right):
    """Cuts where both have an end, one byte offset after the other."""
    ends = [np.cumsum([len(t) for _, t in side]).tolist() for side in (left, right)]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        ni, nj = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(([t for t, _ in left[i:ni]], [t for t, _ in right[j:nj]]))
        i, j = ni, nj
    return groups


def brute(tools, rows):
    found = [(d, *tokens(tools, t)) for d, t in rows]
    groups = [groups_of(left, right) for _, left, right in found]
    count = Counter((a[-1], b[-1]) for g in groups for a, b in g)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for (d, left, right), g in zip(found, groups):
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((d, len(left), len(right), len(g), len(links), sum(count[x] == best[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def test_unusual_texts_equal_brute_force(make, tools):
    rows = list(enumerate(NASTY + random_texts(200, 3) + ["a▁b", "<s>x</s> <0x41>", "   three  spaces ", "tab\t\tx"]))
    assert sorted(rows_of(alignment.align_corpus(make(rows), A, B))) == sorted(brute(tools, rows))


def test_query_equals_brute_force(llm, tools):
    docs = documents(llm, "/root/testdata/sf0.001").select("doc_id", "text").collect()
    got = rows_of(alignment.op12_token_alignment(llm, "/root/testdata/sf0.001"))
    assert sorted(got) == sorted(brute(tools, [(r["doc_id"], r["text"]) for r in docs]))


def test_pointer_jumping_follows_long_chains():
    # tokens of two bytes against tokens of two bytes shifted by one: one chain
    n = 1001
    a_end = np.append(np.arange(2, 2 * n, 2), 2 * n)
    b_end = np.append(np.arange(1, 2 * n, 2), 2 * n)
    a_to, b_to, under = alignment.jump(a_end, b_end)
    assert set(a_to) == set(b_to) == {len(b_end) - 1} and under[-1] == len(a_end) - 1
    a_to, b_to, _ = alignment.jump(np.array([1, 2, 3]), np.array([1, 2, 3]))
    assert a_to.tolist() == b_to.tolist() == [0, 1, 2]
    assert [len(x) for x in alignment.jump(np.zeros(0, int), np.zeros(0, int))] == [0, 0, 0]


def test_long_text_in_parts_gives_the_same_ids(monkeypatch):
    tools = alignment.Tokenizers(A, B)
    text = "Words with  two spaces, and single ones. " * 30
    want = tools.b.encode(text)
    monkeypatch.setattr(alignment, "PART_CHARS", 25)
    assert tools.second([text, "short"]) == [want, tools.b.encode("short")]


def test_pairs_of_the_corpus_are_within_the_bound(llm):
    tools = alignment.Tokenizers(A, B)
    docs = documents(llm, "/root/testdata/sf0.001")
    pairs = alignment.link_counts(alignment.align_documents(docs, A, B)).collect()
    a, b = tools.a_bytes.to_pylist(), tools.b_bytes.to_pylist()
    assert all(a[r["a"]].endswith(b[r["b"]]) or b[r["b"]].endswith(a[r["a"]]) for r in pairs)
    assert len(pairs) <= alignment.most_pairs(tools) < 2_000_000


def test_nulls_repeats_very_long_and_empty(make):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b"), (3, "word and more " * 100_000)]
    got = rows_of(alignment.align_corpus(make(rows), A, B))
    assert len(got) == 6
    by_id = {}
    for r in got:
        by_id.setdefault(r[0], []).append(r)
    assert by_id[1] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2 and len(set(by_id[2])) == 1
    assert by_id[3][0][3] > 300_000
    assert alignment.align_corpus(make(rows).limit(0), A, B).count() == 0
