"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out as one symbol sequence. An index
maps every mergeable pair to all its positions in that sequence; active ranks
leave a heap in ascending order, each is applied at all its live positions from
left to right, and the lists of the pairs that appear are updated. Text is
therefore merged once per distinct word and batch, whatever its frequency, and
results are remembered per worker in a cache bounded in words and in bytes (a
full cache is emptied; nothing depends on it but speed).

The vocabulary file is the tokenizers JSON format: NFC, white space collapsed,
lower case, words by pattern, bytes as printable characters, ``</w>`` on the
last symbol of a word, special-token strings recognised in the raw text. With
no decoder in the file, ids decode to their symbols joined by spaces.

Defined edge cases: null and empty texts encode to no ids and decode to the
empty string; repeated rows are each encoded; null ids are kept; a pair's
overlapping occurrences are merged from the left; a very long text or unbroken
word is encoded whole, through the same index; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_rows, documents, keyed_text, prepare

CACHE_WORDS = 500_000
CACHE_BYTES = 256 << 20  # of words, ids and shown symbols


def byte_symbols() -> dict[int, str]:
    """Printable character of every byte: printable Latin-1 bytes stand for
    themselves, the others follow from code point 256 upwards."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(spare)) for b in range(256)}


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = {i: s for s, i in self.ids.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.pairs = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols.update({i: s for s, i in self.special.items()})
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        table = byte_symbols()
        self.inner = np.array([self.ids.get(table[b], -2) for b in range(256)])
        self.last = np.array([self.ids.get(table[b] + self.suffix, -2) for b in range(256)])
        keys = np.array([a << 20 | b for a, b in self.merge])
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        self.cache: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.held = 0  # bytes in both

    # -- merging -----------------------------------------------------------
    def _layout(self, words: list[str]) -> np.ndarray:
        """Symbols of all words in one row, -1 after each word."""
        data = np.frombuffer("\n".join([*words, ""]).encode("utf-8"), np.uint8)
        stop = data == 10
        final = np.append(stop[1:], False)
        return np.where(stop, -1, np.where(final, self.last[data], self.inner[data]))

    def _pair_index(self, sym: np.ndarray) -> dict[int, list[int]]:
        """rank -> positions of its pair, over the whole sequence."""
        if len(sym) < 2:
            return {}
        both = (sym[:-1] >= 0) & (sym[1:] >= 0)
        at = np.flatnonzero(both)
        key = sym[at] << 20 | sym[at + 1]
        slot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[slot] == key
        at, rank = at[hit], self.pair_ranks[slot[hit]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        first = np.flatnonzero(np.diff(rank, prepend=-1))
        parts = np.split(at, first[1:]) if len(first) else []
        return {r: p.tolist() for r, p in zip(rank[first].tolist(), parts)}

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of distinct, already normalised words."""
        if not words:
            return []
        row = self._layout(words)
        index = self._pair_index(row)
        sym = row.tolist()
        n = len(sym)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merge, pairs = self.merge, self.pairs
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            positions = index.pop(rank, None)
            if positions is None:
                continue
            left, right, whole = pairs[rank]
            positions.sort()
            for k, i in enumerate(positions):
                if sym[i] != left:
                    continue
                j = after[i]
                if sym[j] != right:
                    continue
                sym[i], sym[j] = whole, -2
                nxt = after[j]
                after[i] = nxt
                before[nxt] = i
                lowest = rank
                h = before[i]
                if h >= 0 and (found := merge.get((sym[h], whole))) is not None:
                    lowest = found if found < lowest else lowest
                    if found in index:
                        index[found].append(h)
                    else:
                        index[found] = [h]
                        heapq.heappush(active, found)
                if (found := merge.get((whole, sym[nxt]))) is not None:
                    lowest = found if found < lowest else lowest
                    if found in index:
                        index[found].append(i)
                    else:
                        index[found] = [i]
                        heapq.heappush(active, found)
                if lowest < rank and k + 1 < len(positions):
                    # a lower rank appeared: it goes first, the rest waits
                    index[rank] = positions[k + 1:] + index.pop(rank, [])
                    heapq.heappush(active, rank)
                    break
        row = np.array(sym)
        row = row[row != -2]
        stops = np.flatnonzero(row == -1)
        data = row.astype("<u4").tobytes()
        return [data[4 * s:4 * e] for s, e in zip([0, *(stops[:-1] + 1).tolist()], stops.tolist())]

    # -- texts -------------------------------------------------------------
    def _units(self, text: str) -> list[str]:
        """Normalised white-space units; a special token is a unit too."""
        if self.special and "<|" in text:
            out = []
            for i, chunk in enumerate(self.split_special.split(text)):
                out += [chunk] if i % 2 else self._plain_units(chunk)
            return out
        return self._plain_units(text)

    def _plain_units(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
        else:
            text = unicodedata.normalize("NFC", text)
            # lower case goes by single characters (a final sigma is no exception)
            text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
        if _ODD_SPACE.search(text):
            return [u for u in _SPACE.split(text) if u]
        return text.split()

    def _pieces(self, unit: str) -> list[str]:
        """Words of a unit by the pattern. Code points without a category in
        Python's tables are no letters, whatever newer tables say."""
        if unit.isascii():
            return self.pieces.findall(unit)
        plain = "".join(["\u0378" if unicodedata.category(c) == "Cn" else c for c in unit])
        return [unit[m.start():m.end()] for m in self.pieces.finditer(plain)]

    def learn(self, units: set[str]) -> None:
        """Encode the units that the cache does not hold yet."""
        cache, shown, symbols = self.cache, self.shown, self.symbols
        if len(cache) + len(units) > CACHE_WORDS or self.held > CACHE_BYTES:
            cache.clear()
            shown.clear()
            self.held = 0
        new = units.difference(shown)
        split = {u: self._pieces(u) for u in new.difference(cache, self.special)
                 if not (u.isascii() and u.isalpha())}
        words = new.difference(split, self.special)
        for ws in split.values():
            words.update(ws)
        words = sorted(words.difference(cache))
        cache.update(zip(words, self.encode_words(words)))
        self.held += sum(len(w) + len(cache[w]) for w in words)
        for u, ws in split.items():
            if len(ws) != 1 or ws[0] != u:
                cache[u] = b"".join([cache[w] for w in ws])
        for u in new:
            if u in self.special:
                cache[u] = np.array([self.special[u]], "<u4").tobytes()
            shown[u] = " ".join([symbols[i] for i in np.frombuffer(cache[u], "<u4").tolist()])
            self.held += len(u) + len(shown[u])

    def encode_batch(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(little-endian 32-bit ids, decoded text) of each text."""
        parts = [self._units(t or "") for t in texts]
        self.learn(set().union(*parts))
        cache, shown = self.cache.__getitem__, self.shown.__getitem__
        return [(b"".join(map(cache, p)), " ".join(map(shown, p))) for p in parts]


# where ``str.split`` and the pattern's white space differ
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")

_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The worker's encoder of ``path`` (read once per Python worker)."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids", pa.binary()), ("decoded", pa.string())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary, 32-bit little-endian) ``, decoded``."""
    def run(batches):
        coder = loaded(path)
        for b in batches:
            got = coder.encode_batch(b.column(1).to_pylist())
            yield arrow_rows(RESULT, [(d, len(i) // 4, i, t) for d, (i, t) in zip(b.column(0).to_pylist(), got)])
    return keyed_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """The digest columns of :func:`encode_documents`, taken in the same task
    so that ids and decoded texts do not travel."""
    def run(batches):
        coder = loaded(path)
        for b in batches:
            got = coder.encode_batch(b.column(1).to_pylist())
            yield arrow_rows(DIGEST, [
                (d, len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                for d, (i, t) in zip(b.column(0).to_pylist(), got)])
    return keyed_text(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
