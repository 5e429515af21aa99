"""Cut texts into units that a byte-level BPE tokenizer encodes independently of each other.

A unit is a run of white space with the run of other characters after it.  No pre-token of the
GPT-2 pattern reaches across the end of such a run, so a text's ids are its units' ids in order.
Units repeat a lot, so that encoding each distinct unit once saves most of the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space as Unicode defines it, which is what tokenizers go by (str.isspace knows more).
_UNIT = regex.compile(r"\p{White_Space}*\P{White_Space}+|\p{White_Space}+")


class UnitCache:
    """Values of units: ``values(texts)`` gives for every text the list of its units' values.

    ``encode(units)`` computes values of new units.  About ``limit`` units of up to ``KEPT``
    characters are kept; a full cache starts anew.
    """

    KEPT = 64

    def __init__(self, encode, limit: int = 400_000):
        self.encode = encode
        self.limit = limit
        self.known: dict[str, object] = {}

    def values(self, texts: list[str]) -> list[list]:
        if len(self.known) > self.limit:
            self.known.clear()
        cut = [split(t) for t in texts]
        new = list(set().union(*cut).difference(self.known)) if cut else []
        known = self.known
        known.update(zip(new, self.encode([full(u) for u in new]), strict=True))
        get = known.__getitem__
        found = [list(map(get, units)) for units in cut]
        for u in new:
            if len(u) > self.KEPT:
                del known[u]
        return found


# Texts whose words stand apart by single blanks or line feeds do not have this.
_ODD_SPACE = (
    r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]|[ \n]{2}|\A[ \n]|[ \n]\z"
)


class IdCache:
    """Ids of whole texts from the ids of their units.

    Units are cut and numbered by Arrow, so that Python sees every distinct unit of a batch once.
    ``encode(units)`` gives their ids as bytes of little-endian unsigned 32-bit integers.  At most
    ``limit`` units of up to ``KEPT`` characters are kept, in two halves: when the newer one is full
    it takes the place of the older, from which units in use come back.
    """

    KEPT = 64

    def __init__(self, encode, limit: int):
        self.encode = encode
        self.half = limit // 2
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _values(self, keys: list[str]) -> list[bytes]:
        if len(self.newer) > self.half:
            self.newer, self.older = {}, self.newer
        newer, older = self.newer, self.older
        found = list(map(newer.get, keys))
        unknown = []
        for i in [i for i, v in enumerate(found) if v is None]:
            value = older.get(keys[i])
            if value is None:
                unknown.append(i)
            else:
                found[i] = newer[keys[i]] = value
        for i, value in zip(unknown, self.encode([full(keys[i]) for i in unknown]), strict=True):
            found[i] = value
            if len(keys[i]) <= self.KEPT:
                newer[keys[i]] = value
        return found

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of every text)."""
        empty = np.empty(0, dtype="<u4")
        counts = np.zeros(len(texts), dtype=np.int64)
        odd = np.array(pc.match_substring_regex(texts, _ODD_SPACE)).astype(bool)
        filled = np.array(pc.binary_length(texts)) > 0
        plain = np.flatnonzero(filled & ~odd)
        pieces: list[np.ndarray | None] = [None] * len(texts)
        if len(plain):
            marked = pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n")
            lists = pc.split_pattern(pc.binary_join_element_wise("\0", marked, ""), " ")
            numbered = lists.flatten().dictionary_encode()
            codes = np.array(numbered.indices)
            values = self._values(numbered.dictionary.to_pylist())
            sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
            flat = np.frombuffer(b"".join(values), dtype="<u4")
            starts = np.cumsum(sizes) - sizes
            n = sizes[codes]
            upto = np.cumsum(n)
            ids = flat[np.repeat(starts[codes] - upto + n, n) + np.arange(upto[-1])]
            first = np.array(lists.offsets)[:-1] - lists.offsets[0].as_py()
            counts[plain] = np.add.reduceat(n, first)
            if len(plain) == len(texts):
                return ids, counts
            cuts = np.cumsum(counts[plain])
            for i, piece in zip(plain.tolist(), np.split(ids, cuts[:-1]), strict=True):
                pieces[i] = piece
        for i in np.flatnonzero(filled & odd).tolist():
            values = self._values(["\0" + u for u in _UNIT.findall(texts[i].as_py())])
            pieces[i] = np.frombuffer(b"".join(values), dtype="<u4")
            counts[i] = len(pieces[i])
        return np.concatenate([empty, *(p for p in pieces if p is not None)]), counts


def split(text: str) -> list[str]:
    """Keys of a text's units in order.  ``full`` turns a key into the unit.

    The usual unit is a blank and a word and has the word as its key; others have a key that
    begins with a line feed (as the unit does) or with a zero character before the unit.
    """
    if not text:
        return []
    if " ".join(text.split()) != text.replace("\n", " "):
        # More than single blanks and line feeds between words.
        return ["\0" + u for u in _UNIT.findall(text)]
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = "\0" + keys[0]
    if "\0" in text:
        keys[1:] = [k if k[0] != "\0" else "\0 " + k for k in keys[1:]]
    return keys


def full(key: str) -> str:
    if key[0] == "\0":
        return key[1:]
    return key if key[0] == "\n" else " " + key


def by_bytes(texts: list[str] | list[int], size: int = 4 << 20):
    """Slices of ``texts`` (or of their lengths) of about ``size`` characters, so that a batch's
    memory is bounded."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += t if isinstance(t, int) else len(t)
        if total >= size:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
