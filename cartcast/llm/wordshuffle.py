"""Byte-level BPE through one global shuffle of distinct words.

Encoding explodes texts into pre-tokens (words) with their positions. The
explosion is kept per *block* of consecutive documents: every word has a number
in its block, positions hold numbers, and each distinct word of a block travels
once, to the bucket of its hash. There a word is encoded once, whichever blocks
it comes from, and its ids go back to every block that sent it, where documents
are put together by position. A frequent word is one entry per block, so no key
is larger than another, and a block sends at most ``MOST_BUCKETS`` rows however
large the corpus is. Words are packed by bucket, positions by block.

Decoding joins ids with the table of token bytes: a token's row number in the
table is its id, so the join is one gather per batch of documents.

The input is read twice (words, positions) and must give the same rows in the
same order both times, as a stored table does; a block is named by a digest of
what it holds, and a mismatch is an error, never a wrong result. A lost executor
costs its tasks only.

Defined edge cases: null and empty texts have no ids and decode to no bytes;
null and repeated ids and repeated rows are each kept; an empty table gives no
rows; a very long text is cut into words piece by piece and fills a block of its
own; words of equal bytes are one word; further columns, whatever their names,
are not read. Memory grows with a block (16 MB of text), the longest text, and
the words remembered in a task (a bound; a forgotten word is encoded again).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import documents, keyed_text, prepare

BLOCK_BYTES = 16 << 20    # text of a block
LONG_TEXT = 4 << 20       # characters from which words are taken piece by piece
MOST_BUCKETS = 4096       # rows a block may send
REMEMBERED = 2_000_000    # words a task remembers
SHORT_WORD = 64           # bytes up to which a plain scan finds the least rank
GATHER_WORDS = 1 << 19    # words put together at a time
NEVER = 1 << 62


# -- packed columns ---------------------------------------------------------
def pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


# -- words --------------------------------------------------------------------
class Words:
    """Pre-tokens of texts, as the pattern of a rank file cuts them."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.stand_ins: dict[str, str] = {}

    def _stand_in(self, c: str) -> str:
        """A character of the class that the tiktoken library sees in ``c``:
        its Unicode tables and this process's differ in newer letters."""
        if c not in self.stand_ins:
            import tiktoken
            single = {bytes([b]): b for b in range(256)}
            seen = [k for k in ("L", "N") if tiktoken.Encoding(
                k, pat_str=rf"\p{{{k}}}", mergeable_ranks=single, special_tokens={}).encode_ordinary(c)]
            self.stand_ins[c] = {"L": "x", "N": "0"}[seen[0]] if seen else "#"
        return self.stand_ins[c]

    def cut(self, text: str):
        """Lists of consecutive words."""
        if not text.isascii():
            newer = {c for c in set(text) if c > "ԯ" and unicodedata.category(c) == "Cn"}
            if newer:
                shown = text.translate({ord(c): self._stand_in(c) for c in newer})
                found = (text[m.start():m.end()] for m in self.pattern.finditer(shown))
                while part := list(islice(found, 1 << 18)):
                    yield part
                return
        if len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, 1 << 18)):
            yield part


class Block:
    """Consecutive documents: their words numbered by frequency, and the
    numbers in order of position."""

    def __init__(self, name: str, buckets: int):
        self.name, self.buckets = name, buckets
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: str | None, words: Words) -> None:
        n = 0
        for part in words.cut(text) if text else ():
            self.parts.append(np.fromiter(map(self.number.__getitem__, part), np.uint32, len(part)))
            n += len(part)
        self.ids.append(doc_id)
        self.counts.append(n)
        self.bytes += len(text or "")

    def close(self):
        """``(name, words, bucket of each, positions)``; frequent words have
        small numbers."""
        at = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        words = [w.encode() for w in self.number]
        order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
        new = np.empty(len(words), np.uint32)
        new[order] = np.arange(len(words))
        words = [words[i] for i in order.tolist()]
        at = new[at] if len(at) else at
        bucket = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(self.buckets)
        digest = xxhash.xxh64(at.tobytes())
        digest.update(repr((self.ids, self.counts)).encode())
        digest.update(np.fromiter(map(len, words), "<u4", len(words)).tobytes())
        digest.update(b"".join(words))
        return f"{self.name}-{digest.hexdigest()}", words, bucket.astype(np.int64), at


def blocks(batches, pattern: str, buckets: int):
    """Blocks of the rows ``(doc_id, text)`` of a task, closed."""
    words, part = Words(pattern), TaskContext.get().partitionId()
    block, n = Block(f"{part}-0", buckets), 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if block.ids and block.bytes + len(text or "") > BLOCK_BYTES:
                yield block, *block.close()
                n += 1
                block = Block(f"{part}-{n}", buckets)
            block.add(doc_id, text, words)
    if block.ids:
        yield block, *block.close()


SENT = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("sizes", pa.binary()), ("data", pa.binary())])
HELD = pa.schema([("block", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                  ("buckets", pa.binary()), ("positions", pa.binary())])


def sent_words(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """A row for each block and bucket: sizes and bytes of the distinct words."""
    def run(batches):
        for _, name, words, bucket, _ in blocks(batches, pattern, buckets):
            order = np.argsort(bucket, kind="stable")
            words = [words[i] for i in order.tolist()]
            sizes = np.fromiter(map(len, words), np.uint32, len(words))
            held, starts = np.unique(bucket[order], return_index=True)
            stops = np.append(starts[1:], len(words))
            rows = [(name, b, pack(sizes[s:e]), zstandard.compress(b"".join(words[s:e]), 1))
                    for b, s, e in zip(held.tolist(), starts.tolist(), stops.tolist())]
            for i in range(0, len(rows), 256):
                cols = list(zip(*rows[i:i + 256]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SENT)], schema=SENT)
    return docs.mapInArrow(run, "block string, bucket int, sizes binary, data binary")


def held_positions(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """A row for each block: its documents, the bucket of every word number,
    and the word numbers by position."""
    def run(batches):
        for block, name, _, bucket, at in blocks(batches, pattern, buckets):
            row = (name, block.ids, block.counts, pack(bucket), pack(at))
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, HELD)], schema=HELD)
    return docs.mapInArrow(
        run, "block string, doc_ids array<long>, counts array<long>, buckets binary, positions binary")


# -- ranks --------------------------------------------------------------------
class Ranks:
    """Merge ranks of one file: words to ids, ids to bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.tokens = pa.array(by_id, pa.binary())           # the token-byte table
        self.decimals = pa.array([b"%d " % i for i in range(len(by_id))], pa.binary())
        self.known: dict[bytes, bytes] = {}

    def word(self, word: bytes) -> bytes:
        """Ids of one word (little-endian, 32 bits each): a word in the table
        is one id; else the adjacent pair of least rank, the leftmost of equal
        ones, is merged until no pair has a rank."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return whole.to_bytes(4, "little")
        parts = self._scan(word) if len(word) <= SHORT_WORD else self._agenda(word)
        return np.array([ranks[p] for p in parts], "<u4").tobytes()

    def _scan(self, word: bytes) -> list[bytes]:
        find = self.ranks.get
        parts = [word[i:i + 1] for i in range(len(word))]
        pairs = [find(word[i:i + 2], NEVER) for i in range(len(word) - 1)]
        while pairs and (least := min(pairs)) != NEVER:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = find(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = find(parts[i - 1] + parts[i], NEVER)
        return parts

    def _agenda(self, word: bytes) -> list[bytes]:
        """The same merges for a long word, by a heap of (rank, place)."""
        find, n = self.ranks.get, len(word)
        end = list(range(1, n + 1))          # end of the part that starts here
        before = list(range(-1, n))          # start of the part before
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := find(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j < 0 or j >= n or end[j] != stop:
                continue                     # a part of the pair has changed
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := find(word[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := find(word[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(word[i:end[i]])
            i = end[i]
        return out

    def words(self, sizes: np.ndarray, data: bytes) -> tuple[np.ndarray, bytes]:
        """Ids per word and all ids of the words of one row; each word that is
        new to the task is encoded, once."""
        stops = np.cumsum(sizes, dtype=np.int64).tolist()
        words = [data[s:e] for s, e in zip([0, *stops], stops)]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        out = list(map(known.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = known[words[i]] = self.word(words[i])
        return np.fromiter(map(len, out), np.uint32, len(out)) // 4, b"".join(out)

    def gather(self, table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """The table's entries of ``ids`` in one buffer, and their bounds."""
        got = table.take(pa.array(ids))
        bounds = np.frombuffer(got.buffers()[1], "<i4")[got.offset:got.offset + len(got) + 1]
        return bounds, memoryview(got.buffers()[2] or b"")

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, through the token-byte table."""
        return b"".join(bytes(data[:bounds[-1]]) for part in _parts(ids)
                        for bounds, data in [self.gather(self.tokens, part)])

    def digests(self, ids: np.ndarray) -> tuple[str, str]:
        """SHA-256 of the ids as decimal numbers joined by one space, and of
        the decoded bytes."""
        text, shown = hashlib.sha256(), hashlib.sha256()
        parts = _parts(ids)
        for k, part in enumerate(parts):
            bounds, data = self.gather(self.decimals, part)
            text.update(data[:bounds[-1] - (k + 1 == len(parts))])
            bounds, data = self.gather(self.tokens, part)
            shown.update(data[:bounds[-1]])
        return text.hexdigest(), shown.hexdigest()


def _parts(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i:i + (1 << 20)] for i in range(0, len(ids), 1 << 20)]


_LOADED: dict[str, Ranks] = {}


def loaded(path: str) -> Ranks:
    """The worker's ranks of ``path`` (read once per Python worker)."""
    if path not in _LOADED:
        _LOADED[path] = Ranks(path)
    return _LOADED[path]


# -- joins --------------------------------------------------------------------
def encoded_words(sent: DataFrame, path: str) -> DataFrame:
    """The words of a bucket meet in one task; every row goes back to its
    block with the ids of its words, in the same order."""
    def run(batches):
        ranks = loaded(path)
        ranks.known.clear()
        for b in batches:
            rows = []
            for block, bucket, sizes, data in zip(*[b.column(i).to_pylist() for i in range(4)]):
                n_ids, ids = ranks.words(unpack(sizes), zstandard.decompress(data))
                rows.append((block, bucket, pack(n_ids), pack(np.frombuffer(ids, "<u4"))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), SENT)], schema=SENT)
        ranks.known.clear()
    return sent.repartition("bucket").mapInArrow(run, "block string, bucket int, sizes binary, data binary")


RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def put_together(held: pa.Table, coded: pa.Table) -> pa.Table:
    """Documents of one block from word ids and positions."""
    if held.num_rows != 1:
        raise RuntimeError("the documents changed between two readings; store them first")
    doc_ids, counts = held.column("doc_ids")[0].as_py(), held.column("counts")[0].as_py()
    bucket, at = unpack(held.column("buckets")[0].as_py()), unpack(held.column("positions")[0].as_py())
    rows = sorted(zip(*[coded.column(c).to_pylist() for c in ("bucket", "sizes", "data")]))
    sizes = np.zeros(len(bucket), np.int64)
    order = np.argsort(bucket, kind="stable")
    if rows:
        found = np.concatenate([unpack(r[1]) for r in rows])
        table = np.concatenate([unpack(r[2]) for r in rows])
        if len(found) != len(order):
            raise RuntimeError("words of a block are missing")
        sizes[order] = found
        first = np.empty(len(order), np.int64)
        first[order] = np.cumsum(found, dtype=np.int64) - found
    elif len(order):
        raise RuntimeError("the documents changed between two readings; store them first")
    data, totals = [], []
    ends = np.cumsum(counts)
    for lo, hi in _ranges(counts):
        start = int(ends[lo] - counts[lo])
        parts = []
        for s in range(start, int(ends[hi - 1]), GATHER_WORDS):
            word = at[s:min(s + GATHER_WORDS, int(ends[hi - 1]))]
            n = sizes[word]
            stop = np.cumsum(n)
            parts.append((table[np.repeat(first[word] - (stop - n), n) + np.arange(stop[-1])], n))
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, "<u4")
        stops = np.concatenate([[0], *[p[1] for p in parts]]).cumsum() if parts else np.zeros(1, np.int64)
        bounds = stops[np.concatenate([[0], ends[lo:hi] - start])]
        raw = ids.astype("<u4").tobytes()
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            data.append(raw[4 * s:4 * e])
            totals.append(e - s)
    return pa.Table.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(totals, pa.int64()),
                                 pa.array(data, pa.binary())], schema=RESULT)


def _ranges(counts: list[int]):
    """Runs of documents of about GATHER_WORDS words (at least one document)."""
    lo, size = 0, 0
    for i, n in enumerate(counts):
        if i > lo and size + n > GATHER_WORDS:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(counts):
        yield lo, len(counts)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary, little-endian, 32 bits an id)."""
    docs = keyed_text(docs)
    spark = docs.sparkSession
    buckets = min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    coded = encoded_words(sent_words(docs, pattern, buckets), path)
    held = held_positions(docs, pattern, buckets)
    return held.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        put_together, "doc_id long, n_tokens long, ids binary")


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id, decoded`` (binary) of rows with ``doc_id, ids``."""
    def run(batches):
        ranks = loaded(path)
        for b in batches:
            shown = [ranks.decode(np.frombuffer(i or b"", "<u4")) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shown, pa.binary())], ["doc_id", "decoded"])
    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(coded: DataFrame, path: str) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    def run(batches):
        ranks = loaded(path)
        for b in batches:
            ids = b.column(2).to_pylist()
            both = [ranks.digests(np.frombuffer(i, "<u4")) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in both], pa.string()),
                 pa.array([x[1] for x in both], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return coded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(encode_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN), path)
