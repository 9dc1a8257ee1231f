"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to the farthest-right
token of the other that it overlaps (the one that covers its last byte); of two
tokens that end together the first tokenizer's points to the second's, which
points to itself. Pointers are then doubled (``next = next[next]``) for all
tokens of a batch of documents until nothing changes: each holds the terminal
token of its connected component, and terminals number the groups.

A link is a pair of tokens whose byte ranges end together. Link counts of id
pairs cover the corpus: tasks sum theirs before one small shuffle. The table of
pairs is bounded by the vocabularies alone, since of two tokens that end
together one's bytes are a suffix of the other's: there are at most as many
pairs as token bytes in both vocabularies, times the tokens of equal bytes
(:func:`most_pairs`). So it is safe to give every task all of it.

Alignments are written once to the shared folder and read for the counts and
again for the scores; a lost executor costs its tasks only.

Defined edge cases: null and empty texts, and texts that either tokenizer does
not give back byte by byte, have no tokens: zeros and an empty digest column.
Null and repeated ids and repeated rows are kept and count each; an empty table
gives no rows; equal counts are all the highest; a very long text goes to the
second tokenizer in parts cut before single spaces, where none of its pieces can
reach across; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_bytes, documents, keyed_text, prepare, saved
from .tokens import UnitTokenizer, _byte_characters
from .wordshuffle import pack, unpack

BATCH_BYTES = 2 << 20
UNITS = 150_000           # units a generation of the first tokenizer's memory holds
PART_CHARS = 1 << 20      # characters of a text given to the second tokenizer at once
HELD_PAIRS = 1 << 20      # pairs a task sums before it merges equal ones
_CUT = re.compile(r"(?<=[^ ]) (?=[^ ])")


class Units(UnitTokenizer):
    """Keeps fewer units: the second tokenizer's model shares the worker."""

    def _learn(self, units: set[str]) -> None:
        if len(self.young) > UNITS:
            self.young, self.old = {}, self.young
        super()._learn(units)


class Tokenizers:
    """The two tokenizers with the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        self.a = Units(first)
        self.a.library.encode_special_tokens = True   # their strings in texts are plain
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        vocabulary = self.a.library.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(byte_of[c] if c in byte_of else ord(c) for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.parts = not any("▁" in p.lstrip("▁") for p in pieces)   # no piece spans "x y"
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.a_sizes = np.array([len(t) for t in a_bytes])
        self.b_sizes = np.array([len(t) for t in b_bytes])
        most = max(len(a_bytes), len(b_bytes))
        self.numbers = pa.array([b"%d," % i for i in range(most)], pa.binary())

    def second(self, texts: list[str]) -> list[list[int]]:
        out = self.b.encode([t for t in texts if len(t) <= PART_CHARS or not self.parts], num_threads=1)
        out = iter(out)
        return [next(out) if len(t) <= PART_CHARS or not self.parts else self._in_parts(t) for t in texts]

    def _in_parts(self, text: str) -> list[int]:
        """Ids of a long text: the space before a part comes back as the one
        the tokenizer puts before every text."""
        ids, start = [], 0
        while len(text) - start > PART_CHARS:
            cut = _CUT.search(text, start + PART_CHARS - 1)
            if cut is None:
                break
            ids += self.b.encode(text[start:cut.start()])
            start = cut.end()
        return ids + self.b.encode(text[start:])

    def encode(self, texts: list[str | None]):
        """Ids by each tokenizer, in one row each, with the bounds of the
        texts; texts that are not given back byte by byte have none."""
        texts = [t or "" for t in texts]
        given = [" " + t if t else "" for t in texts]
        a = [np.frombuffer(i, "<u4") for i in self.a.encode(given)]
        b = [np.array(i, np.uint32) for i in self.second(texts)]
        for i, t in enumerate(given):
            want = t.encode()
            if not t or self.bytes_of(self.a_bytes, a[i]) != want or self.bytes_of(self.b_bytes, b[i]) != want:
                a[i] = b[i] = np.zeros(0, np.uint32)
        return a, b

    @staticmethod
    def bytes_of(table: pa.Array, ids: np.ndarray) -> bytes:
        got = table.take(pa.array(ids))
        return (got.buffers()[2] or b"").to_pybytes() if len(got) else b""


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def loaded(first: str, second: str) -> Tokenizers:
    """The worker's tokenizers (read once per Python worker)."""
    if (first, second) not in _LOADED:
        _LOADED[first, second] = Tokenizers(first, second)
    return _LOADED[first, second]


def jump(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terminal token of every token, by pointer doubling.

    ``a_end`` and ``b_end`` are ascending end offsets of tokens that cover the
    same bytes. Returns the terminal (an index of the second's tokens) of each
    token of the first and of the second, and for each token of the second the
    token of the first that covers its last byte."""
    na = len(a_end)
    over = np.searchsorted(b_end, a_end)              # second's token over a's last byte
    under = np.searchsorted(a_end, b_end)             # first's token over b's last byte
    here = na + np.arange(len(b_end))
    after = np.concatenate([na + over, np.where(a_end[under] > b_end, under, here)]) if na else here
    while True:
        far = after[after]
        if np.array_equal(far, after):
            return after[:na] - na, after[na:] - na, under
        after = far


class Aligned:
    """Groups and links of the texts of a batch."""

    def __init__(self, tools: Tokenizers, texts: list[str | None]):
        a_lists, b_lists = tools.encode(texts)
        self.a, self.b = np.concatenate([*a_lists, np.zeros(0, "<u4")]), np.concatenate([*b_lists, np.zeros(0, "<u4")])
        self.a, self.b = self.a.astype(np.int64), self.b.astype(np.int64)
        self.a_at = np.concatenate([[0], np.cumsum([len(x) for x in a_lists])]).astype(np.int64)
        self.b_at = np.concatenate([[0], np.cumsum([len(x) for x in b_lists])]).astype(np.int64)
        a_end, b_end = np.cumsum(tools.a_sizes[self.a]), np.cumsum(tools.b_sizes[self.b])
        a_to, b_to, under = jump(a_end, b_end)
        last = b_to == np.arange(len(b_to))           # terminals
        number = np.cumsum(last) - 1
        self.a_group, self.b_group = number[a_to], number[b_to]
        self.link_b = np.flatnonzero(last)            # one link closes each group
        self.link_a = under[self.link_b]
        self.group_at = np.concatenate([[0], np.cumsum(last)])[self.b_at]
        self.tools = tools

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        groups = int(self.group_at[-1])
        na, nb = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        a_place = np.arange(len(self.a)) + (np.cumsum(nb) - nb)[self.a_group]
        b_place = np.arange(len(self.b)) + np.cumsum(na)[self.b_group]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[a_place], ids[b_place] = self.a, self.b
        got = self.tools.numbers.take(pa.array(ids))
        bounds = np.frombuffer(got.buffers()[1], "<i4")[:len(ids) + 1]
        text = np.frombuffer(got.buffers()[2] or b"", np.uint8)[:bounds[-1]].copy()
        ends = bounds[1:] - 1
        text[ends[a_place[self.link_a]]] = ord("|")
        text[ends[b_place[self.link_b]]] = ord(";")
        view = memoryview(text)
        cuts = bounds[self.a_at + self.b_at].tolist()
        return [hashlib.sha256(view[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(cuts, cuts[1:])]


ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("groups_sha256", pa.string()), ("a_links", pa.binary()), ("b_links", pa.binary())])
ALIGNED_DDL = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
               "a_links binary, b_links binary")


def align_documents(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Per document its tokens, groups and their digest, and the ids of the
    two tokens of each link in order (packed, :func:`wordshuffle.unpack`)."""
    def run(batches):
        tools = loaded(first, second)
        for t in by_bytes(batches, BATCH_BYTES):
            got = Aligned(tools, t.column(1).to_pylist())
            cut = got.group_at.tolist()
            a, b = got.a[got.link_a], got.b[got.link_b]
            cols = [t.column(0).combine_chunks(), np.diff(got.a_at), np.diff(got.b_at), np.diff(got.group_at), got.digests(),
                    [pack(a[s:e]) for s, e in zip(cut, cut[1:])], [pack(b[s:e]) for s, e in zip(cut, cut[1:])]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c
                                              for c, f in zip(cols, ALIGNED)], schema=ALIGNED)
            del got, a, b, cols
            pa.default_memory_pool().release_unused()
    return keyed_text(docs).mapInArrow(run, ALIGNED_DDL)


def most_pairs(tools: Tokenizers) -> int:
    """Bound on the id pairs whose tokens can end together, whatever the
    corpus: pairs of which one token's bytes end the other's."""
    def suffixes(tokens, others):
        held: dict[bytes, int] = {}
        for t in others:
            held[t] = held.get(t, 0) + 1
        return sum(held.get(t[i:], 0) for t in tokens for i in range(len(t)))
    a, b = tools.a_bytes.to_pylist(), tools.b_bytes.to_pylist()
    return suffixes(a, b) + suffixes(b, a)


def _links(b: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [unpack(x) for x in b.column("a_links").to_pylist()], [unpack(x) for x in b.column("b_links").to_pylist()]


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n``, the links of each id pair, and ``best``, the highest
    count of the pair's second id."""
    def run(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, size = [], 0

        def merged():
            every = np.concatenate([codes, *held])
            weight = np.concatenate([counts, np.ones(len(every) - len(codes), np.int64)])
            distinct, at = np.unique(every, return_inverse=True)
            return distinct, np.bincount(at, weight, len(distinct)).astype(np.int64)
        for batch in batches:
            for a, b in zip(*_links(batch)):
                held.append(a.astype(np.int64) << 32 | b)
                size += len(a)
            if size > HELD_PAIRS:
                codes, counts = merged()
                held, size = [], 0
        codes, counts = merged()
        yield pa.RecordBatch.from_arrays([codes >> 32, codes & 0xFFFFFFFF, counts], ["a", "b", "n"])
    part = aligned.select("a_links", "b_links").mapInArrow(run, "a long, b long, n long")
    every = part.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return every.withColumn("best", F.max("n").over(Window.partitionBy("b")))


def score_alignments(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Alignments with ``n_links``, ``n_best`` and ``count_sum``."""
    table = counts.toArrow()   # bounded by the vocabularies, see most_pairs
    code = table.column("a").to_numpy() << 32 | table.column("b").to_numpy()
    order = np.argsort(code)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (code[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order]))

    def run(batches):
        codes, n, best = shared.value
        is_best = n == best
        for batch in batches:
            sums, bests = [], []
            for a, b in zip(*_links(batch)):
                at = np.searchsorted(codes, a.astype(np.int64) << 32 | b)
                sums.append(int(n[at].sum()))
                bests.append(int(is_best[at].sum()))
            keep = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays(
                [*keep, keep[3], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                   "count_sum long, groups_sha256 string")


def align_corpus(docs: DataFrame, first: str, second: str) -> DataFrame:
    aligned = saved(align_documents(docs, first, second), "aligned")
    return score_alignments(aligned, link_counts(aligned))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return align_corpus(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))
