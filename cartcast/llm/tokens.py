"""Token ids by the ``tokenizers`` library, unit by unit.

Both public vocabularies cut a text at spaces before merging, so the ids of a
text are the concatenated ids of its units. A worker remembers the units it has
met (two generations of bounded size; nothing but speed depends on them), and
only new ones go to the library. Where a cut at spaces might differ from the
library's own (unusual white space, special-token strings, letters outside the
common ranges) the whole text goes to the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Units kept per generation: byte-level units keep case and line breaks, and
# so come in more forms than lower-cased words.
BYTE_GENERATION = 700_000
WORD_GENERATION = 200_000
# ASCII without control characters, Latin letters, common punctuation
_UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e¡-¬®-ȷ–-―‘-„…€]")
# Fixed value: the split pattern of byte-level BPE.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Marks of keys that are no plain unit (control characters: in no unit)
_START, _PIECE, _LINE = "\x01", "\x02", " \x03"
_MARKS = frozenset(".,;:!?")
_ENDS = ".,;:!?#$%&()*+-/<=>@[]^_{|}~"  # ASCII punctuation but quotes
_DOUBLE_SPACE = re.compile("[\\t\\n\\r\\x20]\\x20")


def _single_spaced(text: str) -> bool:
    """No white space but single spaces and single line breaks."""
    return not ("\t" in text or "\r" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text)


class UnitTokenizer:
    """Little-endian 32-bit ids of texts, equal to the library's
    ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.words = self.library.normalizer is not None  # lower-cased words without spaces
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["pre_tokenizer"]
        self.pieces = regex.compile(
            spec["pretokenizers"][0]["pattern"]["Regex"] if self.words else BYTE_LEVEL)
        most = self.library.get_vocab_size(with_added_tokens=True)
        self.packed = [i.to_bytes(4, "little") for i in range(most)]
        self.marks = {m: self._piece(m) for m in _MARKS}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain(self, text: str) -> bool:
        """Whether cutting at spaces is safe (else the library has it whole)."""
        if "<|" in text:
            return False
        if not (text.isascii() and text.replace("\n", "").isprintable()) and _UNUSUAL.search(text):
            return False
        return self.words or _single_spaced(text) or not _DOUBLE_SPACE.search(text)

    def _units(self, texts: list[str]) -> pa.ListArray:
        """The units of plain texts; all but a text's first follow a space."""
        if self.words:
            return pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        # a line break without space beside it starts a unit too
        texts = [t.replace("\n", _LINE) if _single_spaced(t) else t for t in texts]
        return pc.split_pattern(pa.array([_START + t for t in texts], pa.large_string()), " ")

    def _learn(self, units: set[str]) -> None:
        """Bring units missing from the young generation into it."""
        if len(self.young) > (WORD_GENERATION if self.words else BYTE_GENERATION):
            self.young, self.old = {}, self.young
        young, old, one, marks = self.young, self.old, self._piece, self.marks
        lead, shown_lead = ("", "") if self.words else (" ", _SHOWN[0x20])
        packed, tokenize = self.packed, self.model.tokenize
        for u in units:
            known = old.get(u)
            if known is None:
                if u.isalpha():
                    if u.isascii():
                        known = b"".join([packed[t.id] for t in tokenize(shown_lead + u)])
                    else:
                        known = one(lead + u)
                elif (word := u.rstrip(_ENDS)).isalpha() and (u[len(word):] in marks or not self.words):
                    # a word and marks without a quote are two pieces
                    known = young.get(word) or old.get(word)
                    if known is None:
                        known = young[word] = one(lead + word)
                    end = u[len(word):]
                    known += marks.get(end) or one(end)
                else:
                    whole = u[1:] if u[:1] == _START else "\n" + u[1:] if u[:1] == _LINE[1] else lead + u
                    known = b""
                    for w in self.pieces.findall(whole):
                        ids = young.get(_PIECE + w) or old.get(_PIECE + w)
                        if ids is None:
                            ids = young[_PIECE + w] = one(w)
                        known += ids
            young[u] = known

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece of the split pattern, by the library's model."""
        packed = self.packed
        shown = charmap_decode(piece.encode("utf-8"), "strict", _SHOWN)[0]
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if t and self._plain(t):
                plain.append(i)
            elif t:
                out[i] = self._whole(t)
        units = self._units([texts[i] for i in plain])
        coded = units.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.young.get, distinct))
        holes = [i for i, x in enumerate(known) if x is None]
        self._learn({distinct[i] for i in holes})
        young = self.young
        for i in holes:
            known[i] = young[distinct[i]]
        # every unit's ids, gathered from those of the distinct units
        taken = pa.array(known, pa.large_binary()).take(coded.indices)
        _, ends, ids = taken.buffers()
        if ids is None or not len(taken):
            return out
        ids = memoryview(ids)
        bounds = np.frombuffer(ends, np.int64)[taken.offset:][units.offsets.to_numpy()]
        for i, s, e in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = ids[s:e].tobytes()
        return out

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


def _byte_characters() -> str:
    """The printable stand-in of each byte: itself, or for those not shown as
    themselves the characters from 256 on."""
    spare = map(chr, range(256, 512))
    return "".join(next(spare) if not chr(b).isprintable() or b in (0x20, 0xA0, 0xAD) else chr(b)
                   for b in range(256))


_SHOWN = _byte_characters()
_LOADED: dict[str, UnitTokenizer] = {}


def loaded(path: str) -> UnitTokenizer:
    """The worker's tokenizer of ``path`` (read once per Python worker)."""
    if path not in _LOADED:
        _LOADED[path] = UnitTokenizer(path)
    return _LOADED[path]
