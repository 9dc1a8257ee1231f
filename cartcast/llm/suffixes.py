"""Suffix-array removal of repeated passages.

A byte goes when it lies in a ``LENGTH``-byte string that also starts in a
document with a smaller ``doc_id``. Equal strings anywhere in the corpus must
meet in one task, without sending every suffix of the corpus through a shuffle:

1. *Anchors.* Of the ``GRAM``-byte hashes inside a ``LENGTH``-byte window the
   smallest is the window's anchor. Equal windows have equal anchors at equal
   places, and about one position in sixteen is an anchor.
2. *Sieve.* Blocks of documents send their distinct anchor hashes, once each,
   to hash buckets; a bucket answers which occur in two documents or more.
   Only windows around those anchors can repeat.
3. *Suffix arrays.* The surroundings of the surviving anchors (all windows
   that hold the anchor), distinct per block and with their smallest
   ``doc_id``, go to the anchor's bucket. There they form one text whose
   suffixes are sorted in two stages: suffixes smaller than their successors
   are sorted directly, the others are induced by scanning the buckets of
   first symbols from left to right. Common prefixes of neighbours of at least
   ``LENGTH`` give the classes of equal strings, and each class the smallest
   document it starts in.
   An anchor that occurs in more than ``HOT_BLOCKS`` blocks (a common phrase)
   is routed twice, with the bytes to its right and with those to its left,
   each for the windows that hold these bytes, so it spreads over buckets.
4. *Removal.* A block learns, per distinct surrounding, which of its windows
   start in a smaller document elsewhere, and removes them.

Blocks and buckets are sized by bytes of text, so their number grows with the
corpus. A passage that a third of all documents share costs one entry per
block, not one per document.

With more than ``FAN_OUT`` buckets a block would send each of them a few bytes.
Steps 2 and 3 then go by way of *gatherers*: a block sends to coarse buckets,
about the root of their number; a gatherer takes one coarse bucket from as many
blocks, merges what they share (an anchor with its number of blocks, a
surrounding with its smallest document) and sends on to the buckets. Answers
return the same way. What a block or gatherer sends stays near one row per
coarse bucket at any size, and a passage of every document is one entry per
gatherer. A document of a gatherer that is not the smallest there loses all
windows of the shared surrounding, whatever the bucket answers.

Equal rows (id, text and carried columns) become one with their number before
the shuffle, per task, and are told apart again at the end.

Defined edge cases: null texts are empty; documents shorter than ``LENGTH``
keep all their bytes; a null ``doc_id`` counts as smaller than every other and
equal to other nulls; rows with equal ids do not remove each other's bytes; an
empty table gives an empty result; long texts are scanned in segments.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, documents, give_back, prepare

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1     # anchors are minima over this many hashes
LEFT = SPAN - 1              # bytes before an anchor that its windows reach
WIDTH = LEFT + LENGTH        # bytes of an anchor's surroundings
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
SEGMENT = 1 << 19
HOT_BLOCKS = 64              # an anchor in more blocks is routed by more bytes
FAN_OUT = 2048               # buckets that a block sends to directly
HOLD_BYTES = 16 << 20        # repeated rows that a task holds before it sends them
TASK_WINDOWS = 20_000        # surroundings whose suffixes are sorted at a time
# Bytes of a surrounding that its windows share, and the windows' numbers: all
# windows hold the anchor's gram; half of them also the bytes to its right
# (side 1), the others those to its left (side 2).
HALF = LEFT // 2
SIDES = ((LEFT, LEFT + GRAM, 0, SPAN), (LEFT, HALF + LENGTH, HALF, SPAN), (HALF, LEFT + GRAM, 0, HALF))
LOWEST = -(1 << 63)          # stands for a null doc_id

_BYTE = np.array([xxhash.xxh64_intdigest(bytes([i]), 1) for i in range(256)], np.uint64)
_ODD = [np.uint64(xxhash.xxh64_intdigest(bytes([i]), 2) | 1) for i in range(16)]


# -- anchors ---------------------------------------------------------------
def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every run of ``width`` neighbours, by doubling."""
    step = 1
    while step * 2 <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return pick(x[:len(x) - (width - step)], x[width - step:]) if step < width else x


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes that start at every position (of the
    last axis)."""
    h = _BYTE[data]
    four = None
    for i, m in enumerate((1, 2, 4, 8)):
        h = h[..., :-m] * _ODD[i] + h[..., m:]
        if m == 2:
            four = h
    h = h[..., :four.shape[-1] - 16] * _ODD[4] + four[..., 16:]
    return (h ^ (h >> np.uint64(29))) * _ODD[5]


class Block:
    """Texts of one block, end to end, in (doc_id, text) order."""

    def __init__(self, ids: list, texts: list):
        rows = sorted(((LOWEST if i is None else i), (t or "").encode("utf-8", "surrogatepass"), at)
                      for at, (i, t) in enumerate(zip(ids, texts)))
        self.order = [at for _, _, at in rows]
        self.ids = np.array([i for i, _, _ in rows], np.int64)
        lengths = np.array([len(t) for _, t, _ in rows], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.data = np.frombuffer(b"".join(t for _, t, _ in rows), np.uint8)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of all anchors, by position."""
        n = len(self.data)
        places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for a in range(0, n, SEGMENT):
            lo, hi = max(0, a - LEFT), min(n, a + SEGMENT + LEFT + LENGTH)
            if hi - lo < LENGTH:
                continue
            h = _gram_hashes(self.data[lo:hi])
            low = _slide(h, SPAN, np.minimum)  # by window start
            # windows that would cross a document's end have no anchor
            first, last = np.searchsorted(self.ends, [lo, hi], side="right")
            for end in self.ends[first:last + 1].tolist():
                low[max(0, end - LENGTH + 1 - lo):max(0, end - lo)] = 0
            edge = np.zeros(LEFT, np.uint64)
            high = _slide(np.concatenate([edge, low, edge]), SPAN, np.maximum)[:len(h)]
            at = np.flatnonzero(high == h[:len(high)])
            at = at[(at >= a - lo) & (at < a - lo + SEGMENT)]
            places.append(at + lo)
            hashes.append(h[at])
        return np.concatenate(places), np.concatenate(hashes)

    def document_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def surroundings(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n, WIDTH) bytes around anchors, zero outside the document, and the
        lengths before and after the anchor that lie inside."""
        doc = self.document_of(at)
        left = np.minimum(LEFT, at - self.starts[doc]).astype(np.uint8)
        right = np.minimum(LENGTH, self.ends[doc] - at).astype(np.uint8)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        out = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at]
        clipped = np.flatnonzero((left < LEFT) | (right < LENGTH))
        col = np.arange(WIDTH)
        out[clipped] *= (col >= LEFT - left[clipped, None].astype(int)) & (col < LEFT + right[clipped, None].astype(int))
        return out, left, right

    def surrounding_hashes(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.uint64)
        for i in range(0, len(at), 50_000):
            out[i:i + 50_000] = surrounding_hash(*self.surroundings(at[i:i + 50_000]))
        return out


def surrounding_hash(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of surroundings with their clipping."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    h = left.astype(np.uint64) << np.uint64(8) | right
    for i in range(words.shape[1]):
        h = (h ^ words[:, i]) * _ODD[6]
        h ^= h >> np.uint64(32)
        h *= _ODD[7]
    return h ^ (h >> np.uint64(29))


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Anchors are small among their neighbours, so they are mixed again."""
    return ((hashes * _ODD[8]) >> np.uint64(32)).astype(np.int64) % n_buckets


def bytes_hash(rows: np.ndarray, side: int) -> np.ndarray:
    """64-bit hash of the bytes that the windows of a side share."""
    lo, hi, _, _ = SIDES[side]
    h = np.zeros(len(rows), np.uint64)
    for c in range(lo, hi):
        h = (h ^ _BYTE[rows[:, c]]) * _ODD[9]
        h ^= h >> np.uint64(31)
    return h


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, dtype, n: int) -> np.ndarray:
    size = n * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), dtype) if n \
        else np.empty(0, dtype)


def _planes(h: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes, byte plane by byte plane (packs well)."""
    return np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T


def _from_planes(data: bytes, n: int) -> np.ndarray:
    planes = _unpack(data, np.uint8, 8 * n).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _by_bucket(bucket: np.ndarray, n_buckets: int):
    """(bucket, positions) of every bucket that occurs, positions ascending."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, order[bounds[b]:bounds[b + 1]]


# -- equal rows ------------------------------------------------------------
def collapse(batches, hold_bytes: int = HOLD_BYTES):
    """Equal rows of a task as one row and ``copies``. The last column is a
    hash of id and text and is dropped. Rows that repeat within a few megabytes
    are held, up to ``hold_bytes``, to be counted over the whole task."""
    held, size = {}, 0

    def out(table, copies):
        return table.append_column("copies", pa.array(copies, pa.int64())).to_batches()

    def flush():
        for row, n in held.values():
            yield from out(row, [n])
    for t in by_bytes(batches):
        keys = t.column(t.num_columns - 1).to_numpy()
        t = t.select(range(t.num_columns - 1))
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        copies = np.bincount(group, minlength=len(first))
        later = np.flatnonzero(first[group] != np.arange(len(keys)))
        if len(later):  # equal hashes of different rows are told apart
            same = np.array([a == b for a, b in zip(t.take(later).to_pylist(), t.take(first[group[later]]).to_pylist())])
            odd = later[~same]
            copies -= np.bincount(group[odd], minlength=len(first))
        else:
            odd = later
        once = np.sort(np.concatenate([first[copies == 1], odd]))
        yield from out(t if len(once) == len(keys) else t.take(once), np.ones(len(once), np.int64))
        for i, n in zip(first[copies > 1].tolist(), copies[copies > 1].tolist()):
            row, key = t.take([i]), int(keys[i])
            if key not in held:
                held[key] = [row, n]
                size += row.nbytes
            elif held[key][0].to_pylist() == row.to_pylist():
                held[key][1] += n
            else:
                yield from out(row, [n])
        if size > hold_bytes:
            yield from flush()
            held, size = {}, 0
    yield from flush()


# -- sieve -----------------------------------------------------------------
SIEVE = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()),
                   ("hashes", pa.binary()), ("weights", pa.binary())])
SIEVE_DDL = "bucket int, block long, n long, hashes binary, weights binary"
MOST = np.iinfo(np.uint16).max  # weights stop there
KNOWN = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])
KNOWN_DDL = "block long, n long, hashes binary, hot binary"


def _block(table: pa.Table) -> Block:
    give_back()
    return Block(table["doc_id"].to_pylist(), table["text"].to_pylist())


def send_anchors(table: pa.Table, coarse: int, fine: int = 1) -> pa.Table:
    """A block's distinct anchor hashes by coarse bucket, with weight 2 if they
    lie in several of its documents, else 1."""
    block = _block(table)
    at, h = block.anchors()
    doc = block.ids[block.document_of(at)]
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    if not len(first):
        return SIEVE.empty_table()
    weight = 1 + (np.maximum.reduceat(doc, first) > np.minimum.reduceat(doc, first)).astype(np.uint16)
    h = h[first]
    return _sieve_rows(h, weight, bucket_of(h, coarse * fine) // fine, coarse, 0, table["block"][0].as_py())


def _sieve_rows(h: np.ndarray, weight: np.ndarray, bucket: np.ndarray, n_buckets: int, base: int, block: int) -> pa.Table:
    rows = [{"bucket": base + b, "block": block, "n": len(i), "hashes": _pack(_planes(h[i])),
             "weights": _pack(weight[i].astype(np.uint16))} for b, i in _by_bucket(bucket, n_buckets)]
    return pa.Table.from_pylist(rows, schema=SIEVE)


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of sieve rows and their total weights, ascending."""
    rows = table.to_pylist()
    every = np.concatenate([_from_planes(r["hashes"], r["n"]) for r in rows])
    weights = np.concatenate([_unpack(r["weights"], np.uint16, r["n"]) for r in rows])
    order = np.argsort(every)
    every, weights = every[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(weights.astype(np.int64), first)


def _found(h: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the ascending ``among``, whether it holds the hash)."""
    if not len(among):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    slot = np.minimum(np.searchsorted(among, h), len(among) - 1)
    return slot, among[slot] == h


def _answers(table: pa.Table, alive: np.ndarray, often: np.ndarray) -> pa.Table:
    """For every sieve row, those of its hashes that are in ``alive``."""
    out = []
    for r in table.to_pylist():
        h = _from_planes(r["hashes"], r["n"])
        at, hit = _found(h, alive)
        if hit.any():
            out.append({"block": r["block"], "n": int(hit.sum()), "hashes": _pack(_planes(h[hit])),
                        "hot": _pack(np.packbits(often[at[hit]]))})
    return pa.Table.from_pylist(out, schema=KNOWN)


def answer_anchors(table: pa.Table, hot_blocks: int) -> pa.Table:
    """For every sender, those of its anchors that two documents have, and
    which of them more than ``hot_blocks`` blocks have."""
    every, weight = _added(table)
    return _answers(table, every[weight > 1], weight[weight > 1] > 2 * hot_blocks)


def gather_anchors(table: pa.Table, coarse: int, fine: int) -> pa.Table:
    """Anchors of a coarse bucket from many blocks, added up, by bucket."""
    h, weight = _added(table)
    c = table["bucket"][0].as_py()
    return _sieve_rows(h, np.minimum(weight, MOST), bucket_of(h, coarse * fine) - c * fine, fine, c * fine,
                       table["gatherer"][0].as_py() * coarse + c)


def return_anchors(table: pa.Table, known: pa.Table) -> pa.Table:
    """A gatherer's answers, for the blocks that sent to it."""
    if not table.num_rows or not known.num_rows:
        return KNOWN.empty_table()
    return _answers(table, *_alive(known))


def _alive(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Answered hashes, ascending, and which are hot."""
    rows = known.to_pylist()
    alive = np.concatenate([_from_planes(r["hashes"], r["n"]) for r in rows])
    often = np.concatenate([_bits(r["hot"], r["n"]) for r in rows])
    order = np.argsort(alive)
    return alive[order], often[order]


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(_unpack(data, np.uint8, -(-n // 8)))[:n].astype(bool)


# -- surroundings ----------------------------------------------------------
ROUTED = pa.schema([("bucket", pa.int32()), ("side", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary()),
                    ("left", pa.binary()), ("right", pa.binary()), ("least", pa.binary())])
ROUTED_DDL = "bucket int, side int, block long, n long, bytes binary, left binary, right binary, least binary"


def _distinct(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of one row per key, smallest id per key), by key."""
    order = np.lexsort((ids, keys))
    k = keys[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    return order[first], ids[order][first]


def send_surroundings(table: pa.Table, known: pa.Table, coarse: int, fine: int = 1) -> pa.Table:
    """Distinct surroundings of a block's surviving anchors, by coarse bucket."""
    if not table.num_rows or not known.num_rows:
        return ROUTED.empty_table()
    block = _block(table)
    at, h = block.anchors()
    alive, often = _alive(known)
    slot, hit = _found(h, alive)
    at, h, hot = at[hit], h[hit], often[slot[hit]]
    pick, least = _distinct(block.surrounding_hashes(at), block.ids[block.document_of(at)])
    at, h, hot = at[pick], h[pick], hot[pick]
    out = []

    def send(some: np.ndarray, keys: np.ndarray, side: int):
        for b, i in _by_bucket(bucket_of(keys, coarse * fine) // fine, coarse):
            i = some[i]
            out.append(_routed_row(b, side, table["block"][0].as_py(), *block.surroundings(at[i]), least[i]))
    send(np.flatnonzero(~hot), h[~hot], 0)
    some = np.flatnonzero(hot)
    if len(some):
        for side in (1, 2):
            keys = np.concatenate([bytes_hash(block.surroundings(at[some[i:i + 50_000]])[0], side)
                                   for i in range(0, len(some), 50_000)])
            send(some, keys, side)
    return pa.Table.from_pylist(out, schema=ROUTED)


def _routed_row(bucket: int, side: int, block: int, rows, left, right, least) -> dict:
    return {"bucket": bucket, "side": side, "block": block, "n": len(rows), "bytes": _pack(rows),
            "left": _pack(left), "right": _pack(right), "least": _pack(least)}


def _by_side(table: pa.Table):
    """(side, its rows) of the sides that occur."""
    rows = table.to_pylist()
    for side in range(len(SIDES)):
        sent = [r for r in rows if r["side"] == side]
        if sent:
            yield side, sent


def _sent(sent: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, left, right, least) of routed rows, end to end."""
    return (np.concatenate([_unpack(r["bytes"], np.uint8, r["n"] * WIDTH).reshape(-1, WIDTH) for r in sent]),
            *[np.concatenate([_unpack(r[c], t, r["n"]) for r in sent])
              for c, t in (("left", np.uint8), ("right", np.uint8), ("least", np.int64))])


def gather_surroundings(table: pa.Table, coarse: int, fine: int) -> pa.Table:
    """Surroundings of a coarse bucket from many blocks, each once with its
    smallest document, by bucket."""
    c, out = table["bucket"][0].as_py(), []
    key = table["gatherer"][0].as_py() * coarse + c
    for side, sent in _by_side(table):
        rows, left, right, least = _sent(sent)
        pick, lowest, _ = _groups(rows, left, right, least, surrounding_hash(rows, left, right))
        rows, left, right = rows[pick], left[pick], right[pick]
        keys = bytes_hash(rows, side) if side else _gram_hashes(rows[:, LEFT:LEFT + GRAM])[:, 0]
        for b, i in _by_bucket(bucket_of(keys, coarse * fine) - c * fine, fine):
            out.append(_routed_row(c * fine + b, side, key, rows[i], left[i], right[i], lowest[i]))
    return pa.Table.from_pylist(out, schema=ROUTED)


# -- two-stage suffix sorting ----------------------------------------------
def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Positions where ``wanted``, in the order of their suffixes.

    ``text``: symbols up to 510, 0 between strings and at the end; suffixes are compared on
    at least their first ``depth`` symbols, further ties stay as they fall.
    Suffixes smaller than their successors (and those at a 0) are sorted
    directly; a suffix larger than its successor is placed when the scan
    reaches that successor, so each bucket of equal first symbols holds its
    induced suffixes, in the order found, before its sorted ones.
    """
    n = len(text)
    follow = np.append(text[1:], 0)
    change = np.flatnonzero(text != follow)  # type runs end where symbols change
    smaller = np.zeros(n, bool)
    if len(change):
        decides = change[np.minimum(np.searchsorted(change, np.arange(n)), len(change) - 1)]
        smaller = text[decides] < follow[decides]
    smaller |= text == 0
    # a larger suffix needs its successor's place, and so on up to a smaller one
    needed = wanted.copy()
    chain = np.flatnonzero(wanted & ~smaller) + 1
    while len(chain):
        chain = chain[chain < n]
        chain = chain[~needed[chain]]
        needed[chain] = True
        chain = chain[~smaller[chain]] + 1
    words = _words(text, depth)
    direct = _sort_direct(np.flatnonzero(needed & smaller), words, depth)
    induced = needed & ~smaller
    symbols = int(text.max()) + 1 if n else 1
    bounds = np.searchsorted(text[direct], np.arange(symbols + 1))
    found: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    out = []

    def scan(places: np.ndarray, symbol: int) -> np.ndarray:
        """Hand predecessors to their buckets; those of this bucket return."""
        before = places[places > 0] - 1
        before = before[induced[before]]
        first = text[before]
        same = before[first == symbol]
        before, first = before[first != symbol], first[first != symbol]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(before, cuts):
            if len(part):
                found[text[part[0]]].append(part)
        return same

    for symbol in range(symbols):
        turn = found[symbol]
        found[symbol] = []
        places = np.concatenate(turn) if turn else np.empty(0, np.int64)
        while len(places):  # runs of one symbol induce within their bucket
            out.append(places)
            places = scan(places, symbol)
        sorted_part = direct[bounds[symbol]:bounds[symbol + 1]]
        if len(sorted_part):
            out.append(sorted_part)
            scan(sorted_part, symbol)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """Seven symbols of nine bits from every position, zero past the end."""
    padded = np.concatenate([text, np.zeros(depth + 14, text.dtype)]).astype(np.uint64)
    pair = padded[:-1] << np.uint64(9) | padded[1:]
    four = pair[:-2] << np.uint64(18) | pair[2:]
    return four[:-4] << np.uint64(27) | (four[4:] >> np.uint64(9))


def _sort_direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Sort by words of seven symbols; each further word only sorts ties."""
    order = places[np.argsort(words[places], kind="stable")]
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for at in range(0, depth, 7):
        key = words[order[tied] + at]
        if at:
            turn = np.lexsort((key, group))
            order[tied] = order[tied][turn]
            key, group = key[turn], group[turn]
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        tied = tied[~alone]
        if not len(tied):
            break
    return order


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``most``
    symbols (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for at in range(0, most, 7):
        x = words[order[alive] + at] ^ words[order[alive - 1] + at]
        # leading equal symbols of the word
        equal = np.zeros(len(x), np.int64)
        for j in range(7):
            equal += x < np.uint64(1 << 9 * (6 - j))
        out[alive] += equal
        alive = alive[equal == 7]
        if not len(alive):
            break
    return np.minimum(out, most)


def smallest_documents(rows: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray,
                       side: int = 0) -> np.ndarray:
    """(n, SPAN): the smallest document that has each window of distinct
    surroundings; the largest integer where there is no window of this side.

    Equal windows of a side share its bytes, so surroundings are taken by the
    hash of those, about ``TASK_WINDOWS`` at a time.
    """
    keys = bytes_hash(rows, side)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    out = np.full((len(rows), SPAN), np.iinfo(np.int64).max)
    at = 0
    while at < len(order):
        # up to the last new key within the size, or the first one after it
        i = np.searchsorted(new, at + TASK_WINDOWS, side="right")
        end = int(new[i - 1]) if i and new[i - 1] > at else int(new[i]) if i < len(new) else len(order)
        if at + TASK_WINDOWS >= len(order):
            end = len(order)
        part = order[at:end]
        out[part] = _sorted_windows(rows[part], left[part], right[part], least[part], side)
        at = end
    return out


def _sorted_windows(rows, left, right, least, side) -> np.ndarray:
    """smallest_documents of surroundings that are sorted together."""
    n = len(rows)
    col = np.arange(WIDTH)
    inside = (col >= LEFT - left[:, None].astype(int)) & (col < LEFT + right[:, None].astype(int))
    text = np.zeros((n, WIDTH + 1), np.uint16)
    text[:, :WIDTH] = (rows.astype(np.uint16) + 1) * inside
    begin = np.arange(SPAN)
    window = (begin >= LEFT - left[:, None].astype(int)) & (begin + LENGTH <= LEFT + right[:, None].astype(int)) \
        & (begin >= SIDES[side][2]) & (begin < SIDES[side][3])
    wanted = np.zeros((n, WIDTH + 1), bool)
    wanted[:, :SPAN] = window
    flat = text.ravel()
    order = two_stage_sort(flat, wanted.ravel(), LENGTH)
    out = np.full((n, SPAN), np.iinfo(np.int64).max)
    if len(order):
        first = np.flatnonzero(common_prefixes(order, _words(flat, LENGTH), LENGTH) < LENGTH)
        lowest = np.minimum.reduceat(least[order // (WIDTH + 1)], first)
        out[order // (WIDTH + 1), order % (WIDTH + 1)] = np.repeat(lowest, np.diff(first, append=len(order)))
    return out


MARKED = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("masks", pa.binary())])
MARKED_DDL = "block long, n long, keys binary, masks binary"
ALL = np.uint32((1 << SPAN) - 1)  # every window


def mark_windows(table: pa.Table) -> pa.Table:
    """Per sender: surroundings with windows that start in a smaller document
    elsewhere, as (hash, bit per window)."""
    out = []
    bits = np.uint32(1) << np.arange(SPAN, dtype=np.uint32)
    for side, sent in _by_side(table):
        rows, left, right, least = _sent(sent)
        keys = surrounding_hash(rows, left, right)
        pick, lowest, group = _groups(rows, left, right, least, keys)
        best = smallest_documents(rows[pick], left[pick], right[pick], lowest, side)
        out += _marks(sent, keys, lambda part: ((best[group[part]] < least[part, None]) @ bits).astype(np.uint32))
    return pa.Table.from_pylist(out, schema=MARKED)


def _marks(sent: list[dict], keys: np.ndarray, masks_of) -> list[dict]:
    """Marked rows of routed rows that lie end to end in ``keys``."""
    out, at = [], 0
    for r in sent:
        part = slice(at, at + r["n"])
        at += r["n"]
        masks = masks_of(part)
        hit = np.flatnonzero(masks)
        if len(hit):
            hit = hit[np.argsort(keys[part][hit])]
            out.append({"block": r["block"], "n": len(hit), "keys": _pack(_planes(keys[part][hit])),
                        "masks": _pack(masks[hit])})
    return out


def _masks(marked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Marked hashes, ascending, and their masks; a surrounding that both
    sides have routed has two entries."""
    got = marked.to_pylist()
    if not got:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    keys = np.concatenate([_from_planes(r["keys"], r["n"]) for r in got])
    masks = np.concatenate([_unpack(r["masks"], np.uint32, r["n"]) for r in got])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.bitwise_or.reduceat(masks[order], first)


def return_marks(table: pa.Table, marked: pa.Table) -> pa.Table:
    """A gatherer's marks, for the blocks that sent to it: all windows of a
    surrounding that a smaller document of the gatherer has, else the bucket's
    marks."""
    known, masks = _masks(marked)
    out = []
    for _, sent in _by_side(table):
        rows, left, right, least = _sent(sent)
        keys = surrounding_hash(rows, left, right)
        _, lowest, group = _groups(rows, left, right, least, keys)
        slot, hit = _found(keys, known)
        mask = np.where(least > lowest[group], ALL, np.uint32(0))
        mask[hit] |= masks[slot[hit]]
        out += _marks(sent, keys, lambda part: mask[part])
    return pa.Table.from_pylist(out, schema=MARKED)


def _groups(rows, left, right, least, keys):
    """One row per distinct surrounding, its smallest document, and the group
    of every row; equal hashes of different bytes are told apart."""
    pick, lowest = _distinct(keys, least)
    group = np.searchsorted(keys[pick], keys)
    if (rows[pick][group] == rows).all():
        return pick, lowest, group
    whole = np.concatenate([rows, left[:, None], right[:, None]], 1)
    _, pick, group = np.unique(whole, axis=0, return_index=True, return_inverse=True)
    group = group.ravel()
    lowest = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(lowest, group, least)
    return pick, lowest, group


# -- removal ---------------------------------------------------------------
def removed_bytes(block: Block, keys: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Flag of every byte of a block that goes; ``keys`` ascending."""
    at, _ = block.anchors()
    starts = np.zeros(len(block.data) + LENGTH, bool)
    own = block.surrounding_hashes(at)
    doc = block.document_of(at)
    pick, least = _distinct(own, block.ids[doc])
    later = block.ids[doc] > least[np.searchsorted(own[pick], own)]
    mask = np.where(later, ALL, np.uint32(0))
    slot, marked = _found(own, keys)
    mask[marked] |= masks[slot[marked]]
    hit = np.flatnonzero(mask)
    at, doc, mask = at[hit], doc[hit], mask[hit]
    low, high = block.starts[doc], block.ends[doc] - LENGTH
    for j in range(SPAN):
        s = at - LEFT + j
        starts[s[(mask >> np.uint32(j) & np.uint32(1)).astype(bool) & (s >= low) & (s <= high)]] = True
    total = np.cumsum(starts[:len(block.data)])
    covered = total > 0
    covered[LENGTH:] = total[LENGTH:] > total[:-LENGTH]
    return covered


def suffix_dedup(docs: DataFrame, with_text: bool = False, carry: tuple[str, ...] = (),
                 block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                 hot_blocks: int = HOT_BLOCKS, fan_out: int = FAN_OUT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document.

    ``with_text`` adds ``kept`` (binary, the remaining bytes) and ``kept_text``
    (without bytes that no longer form a character), and ``carry`` names
    columns of ``docs`` to pass through.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, n_buckets = max(1, -(-total // block_bytes)), max(1, -(-total // bucket_bytes))
    base = base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
    rows = base.withColumn("row_key", F.xxhash64("doc_id", "text")).mapInArrow(
        collapse, T.StructType([*base.schema.fields, T.StructField("copies", T.LongType())]))
    fields = [T.StructField("doc_id", T.LongType()), *[T.StructField(c, docs.schema[c].dataType) for c in carry],
              T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
              T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields += [T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())]

    def remove(table: pa.Table, marked: pa.Table) -> pa.Table:
        block = _block(table)
        gone = removed_bytes(block, *_masks(marked))
        n_removed, n_spans, sha, kept = [], [], [], []
        for s, e in zip(block.starts.tolist(), block.ends.tolist()):
            g = gone[s:e]
            rest = block.data[s:e][~g].tobytes()
            n_removed.append(int(g.sum()))
            n_spans.append(int((g[1:] & ~g[:-1]).sum() + g[:1].sum()))
            sha.append(hashlib.sha256(rest).hexdigest())
            if with_text:
                kept.append(rest)
        table = table.take(block.order)
        cols = [table["doc_id"], *[table[f"carry_{i}"] for i in range(len(carry))],
                pa.array(block.ends - block.starts), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                pa.array(sha, pa.string()), *([pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())]
                  if with_text else []), table["copies"]]
        return pa.Table.from_arrays(cols, names=[*[f.name for f in fields], "copies"])

    coarse = n_buckets if n_buckets <= fan_out else math.isqrt(n_buckets - 1) + 1
    fine = -(-n_buckets // coarse)

    def gathered(sent: DataFrame):
        # as many blocks as coarse buckets: a gatherer gets about what a block sends
        return sent.withColumn("gatherer", F.expr(f"block div {coarse}")).groupBy("bucket", "gatherer")

    def returned(answers: DataFrame):
        return (answers.withColumn("bucket", F.expr(f"cast(block % {coarse} as int)"))
                .withColumn("gatherer", F.expr(f"block div {coarse}")).groupBy("bucket", "gatherer"))

    def by_way_of_gatherers(sent: DataFrame, gather, answer, give) -> DataFrame:
        """Answers of the buckets to the blocks that sent."""
        if fine == 1:
            return sent.groupBy("bucket").applyInArrow(*answer)
        at_gatherers = gathered(sent)
        answers = at_gatherers.applyInArrow(lambda t: gather(t, coarse, fine), sent.schema).groupBy("bucket").applyInArrow(*answer)
        return at_gatherers.cogroup(returned(answers)).applyInArrow(give, answer[1])

    # one shuffle of the texts serves all three uses of the blocks
    blocks = rows.groupBy("block")
    known = by_way_of_gatherers(blocks.applyInArrow(lambda t: send_anchors(t, coarse, fine), SIEVE_DDL), gather_anchors,
                                (lambda t: answer_anchors(t, hot_blocks), KNOWN_DDL), return_anchors)
    routed = blocks.cogroup(known.groupBy("block")).applyInArrow(
        lambda t, k: send_surroundings(t, k, coarse, fine), ROUTED_DDL)
    marked = by_way_of_gatherers(routed, gather_surroundings, (mark_windows, MARKED_DDL), return_marks)
    done = blocks.cogroup(marked.groupBy("block")).applyInArrow(
        remove, T.StructType([*fields, T.StructField("copies", T.LongType())]))
    names = [f.name for f in fields]
    return done.select(*names, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(*names)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup(documents(spark, sf_dir))
