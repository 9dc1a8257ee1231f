"""Token ids on disk, compressed by a Re-Pair grammar per shard.

A shard is a run of documents in ascending ``doc_id`` order, about
``SHARD_TOKENS`` ids. Rounds replace its frequent adjacent pairs by
nonterminals: a round counts the pairs that lie within a document, takes up to
``PAIRS_PER_ROUND`` of the most frequent, lets the more frequent of two
overlapping occurrences win, and writes one rule per pair. Rounds go on until
no pair has ``LEAST_USES`` occurrences that do not overlap. The first round
looks at all pairs; a count only falls unless a new nonterminal is part of the
pair, so later rounds look at pairs beside new nonterminals and at pairs that
were frequent but left over (past the number a round takes, or without a hash
slot). What is stored is
the rules, the expansion length of every rule, the symbols that are left and,
per document, its count of symbols and of ids, so that one document is decoded
without the others. Symbols have 24 bits: a shard holds at most ``MOST_RULES``
rules, which only a single document of over 60 million ids could exceed.

File format: Parquet, one row per shard (``SHARD_DDL``); symbols are 24-bit,
as a plane of low 16-bit halves and a plane of high bytes. Rows carry
(range partition, shard) so that reading needs no listing order.

Defined edge cases: null and empty texts hold the end id alone; repeated rows
and equal ids are each written, ordered by text; null ids come first; a long
document fills a shard of its own; of two pairs that occur equally often the
smaller goes first; an empty table writes no shard; further columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import by_bytes, documents, keyed_text, prepare, saved

SHARD_TOKENS = 1_000_000
PAIRS_PER_ROUND = 16384
SLOT_BITS = 17
LEAST_USES = 4
FIRST_RULE = 1 << 17  # above every vocabulary id
MOST_RULES = (1 << 24) - FIRST_RULE
END_ID = 0

SHARD = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("doc_symbols", pa.list_(pa.int64())), ("rules", pa.binary()),
    ("rule_lengths", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
SHARD_DDL = ("part int, shard int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
             "doc_symbols array<long>, rules binary, rule_lengths binary, low binary, high binary")


def _frequent(keys: np.ndarray, least: int) -> np.ndarray:
    """Values of ``keys`` with at least ``least`` uses, by falling frequency."""
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    uses = np.diff(first, append=len(ordered))
    often = np.flatnonzero(uses >= least)
    often = often[np.argsort(-uses[often], kind="stable")]
    return ordered[first[often]]


def _every_other(follows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which occurrences count: in a run of one pair (``follows``: begins where
    the one before ends) every other occurrence."""
    counts = np.ones(len(keys), bool)
    repeat = np.flatnonzero(follows & (keys[1:] == keys[:-1])) + 1
    if len(repeat):
        begins = np.ones(len(repeat), bool)
        begins[1:] = repeat[1:] != repeat[:-1] + 1
        begin = repeat[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        counts[repeat[(repeat - begin) % 2 == 0]] = False
    return counts


def compress(seq: np.ndarray, last: np.ndarray, rounds: int | None = None,
             most: int = PAIRS_PER_ROUND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grammar of a shard; ``rounds`` bounds the rounds, None is until no pair
    is frequent.

    ``seq``: uint32 ids of all documents; ``last``: true at each document's
    final id. Returns (symbols, last, rules) with rules as (n, 2) uint32.
    Replaced positions stay where they are and are stepped over by links to the
    next and the former symbol, so a round costs what it looks at; they are
    taken out once half of the positions are dead.
    """
    rules = [np.empty((0, 2), np.uint32)]
    next_rule, done, gone = FIRST_RULE, 0, 0
    follow, former = _links(len(seq))
    alive = np.ones(len(seq), bool)
    at = np.flatnonzero(~last[:-1])  # where pairs begin that may be frequent
    while rounds is None or done < rounds:
        done += 1
        if len(at) < LEAST_USES:
            break
        then = follow[at]
        keys = seq[at].astype(np.uint64) << np.uint64(32) | seq[then]
        counts = _every_other(at[1:] == then[:-1], keys)
        frequent = _frequent(keys[counts], LEAST_USES)
        chosen = frequent[:min(most, FIRST_RULE + MOST_RULES - next_rule)]
        if not len(chosen):
            break
        # what stays frequent without being replaced is looked at again; a
        # slot may hold a rare pair too, which the next count drops
        slots = _slot(keys)
        often = np.zeros(1 << SLOT_BITS, bool)
        often[_slot(frequent)] = True
        often = often[slots]
        left = at[often]
        often = np.flatnonzero(often & counts)
        at, keys, slots = at[often], keys[often], slots[often]
        # rank of each position's pair by a hash table that keeps, of pairs
        # falling on one slot, the most frequent
        table = np.full(1 << SLOT_BITS, -1, np.int32)
        table[_slot(chosen[::-1])] = np.arange(len(chosen) - 1, -1, -1, dtype=np.int32)
        rank = table[slots]
        hit = np.flatnonzero((rank >= 0) & (chosen[rank] == keys))
        at, rank = at[hit], rank[hit]
        # of overlapping occurrences of two pairs the more frequent wins
        near = at[1:] == follow[at[:-1]]
        win = np.ones(len(at), bool)
        win[1:] &= ~(near & (rank[:-1] < rank[1:]))
        win[:-1] &= ~(near & (rank[1:] < rank[:-1]))
        win = np.flatnonzero(win)
        at, rank = at[win], rank[win]
        uses = np.bincount(rank, minlength=len(chosen))
        paid = uses >= LEAST_USES  # the most frequent pair always is
        if not paid.all():
            stays = np.flatnonzero(paid[rank])
            at, rank = at[stays], rank[stays]
        number = (np.cumsum(paid) - 1 + next_rule).astype(np.uint32)
        pair = chosen[paid]
        rules.append(np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        seq[at] = number[rank]
        dead = follow[at]
        alive[dead] = False
        gone += len(dead)
        last[at] = last[dead]  # a pair never begins at a final id
        after = follow[dead]
        follow[at] = after
        former[after] = at
        look = np.zeros(len(seq) + 1, bool)  # one more place: before the first symbol
        look[left] = True
        look[at] = True
        look[former[at]] = True
        look = look[:-1]
        look &= alive
        look &= ~last
        next_rule += int(paid.sum())
        if 2 * gone > len(seq):
            stays = np.flatnonzero(alive)
            seq, last, look = seq[stays], last[stays], look[stays]
            follow, former = _links(len(seq))
            alive, gone = np.ones(len(seq), bool), 0
        at = np.flatnonzero(look)
    return seq[alive], last[alive], np.concatenate(rules)


def _links(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Next and former place of every place; both have a place ``n`` for none."""
    former = np.arange(-1, n)
    former[0] = n
    return np.arange(1, n + 2), former


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).view(np.int64)


def rule_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids that each rule expands to; rules refer to earlier rules only."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - FIRST_RULE] if a >= FIRST_RULE else 1)
                   + (out[b - FIRST_RULE] if b >= FIRST_RULE else 1))
    return np.array(out, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of a symbol sequence: rules are expanded once, then gathered."""
    flat = rules.ravel().astype(np.int64)
    while (rule := flat >= FIRST_RULE).any():  # one pass per round of the grammar
        size = np.where(rule, 2, 1)
        begin = np.cumsum(size) - size
        longer = np.empty(int(size.sum()), np.int64)
        longer[begin] = np.where(rule, rules[np.where(rule, flat - FIRST_RULE, 0), 0], flat)
        longer[begin[rule] + 1] = rules[flat[rule] - FIRST_RULE, 1]
        flat = longer
    # every symbol's run in one table: ids as themselves, then the rules
    table = np.concatenate([np.arange(FIRST_RULE, dtype=np.uint32), flat.astype(np.uint32)])
    starts = np.concatenate([np.arange(FIRST_RULE), FIRST_RULE + np.cumsum(lengths) - lengths])
    sizes = np.concatenate([np.ones(FIRST_RULE, np.int64), lengths])[symbols]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return table[np.repeat(starts[symbols] - (ends - sizes), sizes) + np.arange(total)]


def _shard_row(part: int, shard: int, ids: list, data: list[bytes]) -> pa.RecordBatch:
    counts = np.array([len(d) // 4 for d in data], np.int64)
    last = np.zeros(int(counts.sum()), bool)
    last[np.cumsum(counts) - 1] = True
    symbols, last, rules = compress(np.frombuffer(b"".join(data), "<u4").copy(), last)
    ends = np.flatnonzero(last) + 1
    return pa.RecordBatch.from_pylist([{
        "part": part, "shard": shard, "n_tokens": int(counts.sum()), "doc_ids": ids,
        "doc_tokens": counts.tolist(), "doc_symbols": np.diff(ends, prepend=0).tolist(),
        "rules": rules.astype("<u4").tobytes(), "rule_lengths": rule_lengths(rules).astype("<i8").tobytes(),
        "low": (symbols & 0xFFFF).astype("<u2").tobytes(), "high": (symbols >> 16).astype(np.uint8).tobytes(),
    }], schema=SHARD)


def token_shards(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shards (``SHARD_DDL``) of all documents in ascending ``doc_id`` order."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        coder, part, shard = tokens.loaded(path), TaskContext.get().partitionId(), 0
        ids, data, held = [], [], 0
        for b in by_bytes(batches):
            for d, i in zip(b.column(0).to_pylist(), coder.encode(b.column(1).to_pylist())):
                ids.append(d)
                data.append(i + end)
                held += len(i) // 4 + 1
                if held >= shard_tokens:
                    yield _shard_row(part, shard, ids, data)
                    ids, data, held, shard = [], [], 0, shard + 1
        if ids:
            yield _shard_row(part, shard, ids, data)
    # equal ids are spread by a hash of the text, so that they cannot fill one task
    ordered = (keyed_text(docs).withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    return ordered.select("doc_id", "text").mapInArrow(run, SHARD_DDL)


def shard_symbols(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, rule lengths) of one stored shard."""
    symbols = np.frombuffer(row["low"], "<u2").astype(np.uint32) | \
        np.frombuffer(row["high"], np.uint8).astype(np.uint32) << 16
    return (symbols, np.frombuffer(row["rules"], "<u4").reshape(-1, 2),
            np.frombuffer(row["rule_lengths"], "<i8"))


def decode_document(row: dict, at: int) -> np.ndarray:
    """Ids of the ``at``-th document of a shard, without the others."""
    symbols, rules, lengths = shard_symbols(row)
    ends = np.cumsum(row["doc_symbols"])
    return expand(symbols[ends[at] - row["doc_symbols"][at]:ends[at]], rules, lengths)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``(part, shard, before)``: ids in all shards before. Totals per range
    partition are summed first, so the one unpartitioned window sees a row per
    partition."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("parts_before"))
    run = Window.partitionBy("part").orderBy("shard")
    return (shards.select("part", "shard", "n_tokens")
            .withColumn("within", F.sum("n_tokens").over(run) - F.col("n_tokens")).join(parts, "part")
            .select("part", "shard", (F.col("within") + F.col("parts_before")).alias("before")))


DOCS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()),
                  ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = expand(*shard_symbols(row)).astype("<u4").tobytes()
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                view = memoryview(ids)
                crcs = [zlib.crc32(view[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(counts),
                     pa.array(crcs, pa.int64())], schema=DOCS)
    decoded = shards.mapInArrow(
        run, "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return (decoded.join(shard_starts(shards), ["part", "shard"])
            .select("doc_id", (F.col("within") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files to the shared scratch folder; the table of them."""
    return saved(token_shards(docs, path, shard_tokens), "token-shards")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return read_documents(token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))
