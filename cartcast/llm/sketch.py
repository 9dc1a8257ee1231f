"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraphs: lines, and within lines blocks of ``LEAST`` to
``MOST`` bytes that end with a sentence where there is one. A block without a
sentence end is cut after the word of smallest hash among those that lie within
these bounds, and where there are no words after the smallest four bytes'; a cut
depends on the bytes around it only, so that texts agree again soon after an
edit, whatever their script and however long their lines. The first ``START``
bytes of every text have finer blocks, so that short texts have several. Every
paragraph (with its number among equal ones) is hashed
to 64 bits and added to ``HASHES`` cells of a small table; a cell holds a
count, the XOR of digests and the XOR of their checks. Two tables of one size
subtract cell by cell; what both texts share cancels, and peeling cells that
hold a single digest recovers the digests that differ. If peeling stops short,
both tables are built again with twice the cells until it succeeds.

The likeness of two texts is the share of common paragraphs among all of
either text, from the recovered differences and the paragraph counts. Equal
texts have equal fingerprints; a fingerprint is the smallest table as text.

Consecutive documents meet in one task: documents are range-partitioned and
sorted by ``doc_id``. The first and the last text of every partition, two rows
each, are set aside and joined afterwards, last to the next partition's first.

Defined edge cases: null and empty texts have no paragraph (an all-zero
table); two texts without paragraphs are alike (1), and one without to one
with is not (0); repeated rows and equal ids follow each other by text; null
ids come first; a single document is its own next; a very long text takes as many
cells as its differences ask for; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, documents, keyed_text, prepare, saved

CELLS = 12
HASHES = 3
LEAST, MOST = 48, 160
START, START_LEAST, START_MOST = 128, 8, 32
BLOCK = re.compile(rb".{%d,}?[.!?]+(?= )|.+" % LEAST)
WIDE = 16  # digests from which a table is filled by array operations


def _cut(block: bytes, at: int, least: int, most: int) -> int:
    """Where the part of a long block that starts at ``at`` ends."""
    window = block[at + least:at + most]
    words = window.split(b" ")
    inner = list(map(zlib.crc32, words[1:-1]))  # words that lie in the window whole
    if inner:
        n = inner.index(min(inner)) + 2
        return at + least + sum(map(len, words[:n])) + n - 1
    grams = [zlib.crc32(window[i:i + 4]) for i in range(len(window) - 3)]
    return at + least + grams.index(min(grams)) + 4


def blocks(text: str):
    """The paragraphs of a text, as bytes."""
    for found in BLOCK.finditer(text.encode("utf-8", "surrogatepass")):
        block, begin, at = found.group(), found.start(), 0
        while True:
            least, most = (START_LEAST, START_MOST) if begin + at < START else (LEAST, MOST)
            if len(block) - at <= most:
                break
            end = _cut(block, at, least, most)
            yield block[at:end]
            at = end
        yield block[at:]


def paragraph_digests(text: str | None) -> list[int]:
    """64-bit digests of the paragraphs; equal ones are numbered apart."""
    seen: dict[int, int] = {}
    out = []
    for block in blocks(text or ""):
        block = block.strip()
        if block:
            h = xxhash.xxh64_intdigest(block, 1)
            n = seen[h] = seen.get(h, -1) + 1
            out.append(xxhash.xxh64_intdigest(h.to_bytes(8, "little"), n + 2) if n else h)
    return out


def _check(digest: int) -> int:
    return (digest * 0x9E3779B97F4A7C15 >> 29) & 0xFFFFFFFF


def _cells(digest: int, part: int) -> list[int]:
    """One cell in each of the HASHES equal parts of a table."""
    return [digest % part, part + (digest >> 20 | (digest & 0xFFFFF) << 44) % part,
            2 * part + (digest >> 40 | (digest & 0xFFFFFFFFFF) << 24) % part]


class Sketch:
    """Counts, digest sums and check sums of ``CELLS << level`` cells."""

    def __init__(self, digests: list[int], level: int = 0):
        self.level = level
        size = CELLS << level
        part = size // HASHES
        if len(digests) >= WIDE:
            d = np.array(digests, np.uint64)
            cells = np.concatenate([c.astype(np.int64) for c in _cells(d, np.uint64(part))])
            keys, checks = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
            np.bitwise_xor.at(keys, cells, np.tile(d, HASHES))
            np.bitwise_xor.at(checks, cells, np.tile(_check(d), HASHES))
            self.count = np.bincount(cells, minlength=size).tolist()
            self.keys, self.checks = keys.tolist(), checks.tolist()
            return
        self.count = [0] * size
        self.keys = [0] * size
        self.checks = [0] * size
        for d in digests:
            c = _check(d)
            for at in _cells(d, part):
                self.count[at] += 1
                self.keys[at] ^= d
                self.checks[at] ^= c

    def data(self) -> bytes:
        return (np.array(self.count, "<u4").tobytes() + np.array(self.keys, "<u8").tobytes()
                + np.array(self.checks, "<u4").tobytes())

    def differences(self, other: "Sketch") -> tuple[list[int], list[int]] | None:
        """Digests only here and only there; None if peeling stops short."""
        size = len(self.count)
        part = size // HASHES
        count = [a - b for a, b in zip(self.count, other.count)]
        keys = [a ^ b for a, b in zip(self.keys, other.keys)]
        checks = [a ^ b for a, b in zip(self.checks, other.checks)]
        here, there = [], []
        queue = [i for i in range(size) if count[i] in (1, -1)]
        while queue:
            i = queue.pop()
            sign, d = count[i], keys[i]
            if sign not in (1, -1) or _check(d) != checks[i] or i not in _cells(d, part):
                continue
            (here if sign == 1 else there).append(d)
            c = _check(d)
            for at in _cells(d, part):
                count[at] -= sign
                keys[at] ^= d
                checks[at] ^= c
                if count[at] in (1, -1):
                    queue.append(at)
        if any(count) or any(keys) or any(checks):
            return None
        return here, there


class Versions:
    """The sketches of one text, built as larger ones are asked for."""

    def __init__(self, text: str | None):
        self.digests = paragraph_digests(text)
        self.levels = [Sketch(self.digests)]

    def level(self, n: int) -> Sketch:
        while len(self.levels) <= n:
            self.levels.append(Sketch(self.digests, len(self.levels)))
        return self.levels[n]

    def compare(self, other: "Versions") -> tuple[list[int], list[int], int]:
        """(only here, only there, level that sufficed)."""
        if self.digests == other.digests:
            return [], [], 0
        # differences are at least the difference in size, which the tables'
        # counts tell: levels that cannot hold it are not tried
        level = 0
        while CELLS << level < abs(len(self.digests) - len(other.digests)):
            level += 1
        while CELLS << level < 64 * (len(self.digests) + len(other.digests) + CELLS):
            found = self.level(level).differences(other.level(level))
            if found is not None:
                return *found, level
            level += 1
        # two paragraphs of one text with the same 64-bit digest never peel
        here, there = Counter(self.digests), Counter(other.digests)
        return list((here - there).elements()), list((there - here).elements()), level

    def likeness(self, other: "Versions") -> float:
        here, there, _ = self.compare(other)
        total = len(self.digests) + len(there)
        return (len(self.digests) - len(here)) / total if total else 1.0


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the next one's start."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


ROWS = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
ROWS_DDL = ("kind int, part int, doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
            "edited_fingerprint binary, near_edited double, near_next double, text string")
RESULT, FIRST, LAST = 0, 1, 2


def compared(part: int, doc_id: int | None, text: str, own: Versions, following: str, after: Versions) -> tuple:
    """The result row of one document and its next one."""
    new = edited_text(text, following)
    edited = Versions(new)
    return (RESULT, part, doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(),
            own.level(0).data(), edited.level(0).data(), own.likeness(edited), own.likeness(after), None)


def _within_partitions(docs: DataFrame) -> DataFrame:
    """Results of all documents but the partitions' last ones, and the first
    and last text of every partition."""
    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                now = (doc_id, text, Versions(text))
                if held is None:
                    rows.append((FIRST, part, doc_id, *[None] * 6, text))
                else:
                    rows.append(compared(part, *held, text, now[2]))
                held = now
            yield arrow_rows(ROWS, rows)
        if held is not None:
            yield arrow_rows(ROWS, [(LAST, part, held[0], *[None] * 6, held[1])])
    # equal ids are spread by a hash of the text, so that they cannot fill one task
    ordered = (keyed_text(docs).withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    return ordered.select("doc_id", "text").mapInArrow(run, ROWS_DDL)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every document."""
    spark = docs.sparkSession
    rows = saved(_within_partitions(docs), "fingerprints")
    parts = sorted(r["part"] for r in rows.filter(F.col("kind") == FIRST).select("part").collect())
    turn = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    first = rows.filter(F.col("kind") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    ends = (rows.filter(F.col("kind") == LAST).select("part", "doc_id", "text")
            .join(turn, "part").join(first, "next_part").select("part", "doc_id", "text", "following"))

    def run(batches):
        for b in batches:
            yield arrow_rows(ROWS, [
                compared(r["part"], r["doc_id"], r["text"], Versions(r["text"]), r["following"], Versions(r["following"]))
                for r in b.to_pylist()])
    out = rows.filter(F.col("kind") == RESULT).union(ends.mapInArrow(run, ROWS_DDL))
    return out.select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
                      *[F.base64(c).alias(c) for c in ("fingerprint", "edited_fingerprint")],
                      "near_edited", "near_next")


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return document_fingerprints(documents(spark, sf_dir))
