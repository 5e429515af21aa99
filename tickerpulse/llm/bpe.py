"""Byte-pair encoding and decoding in numpy.

Words of many documents are encoded together.  Their symbols stand in one flat array; a round
looks up all neighbouring pairs by binary search in the sorted pair keys, takes the lowest rank
of every word and merges that pair wherever the word has it.  Words without a known pair leave.
A merge can only make pairs of a higher rank than its own, so this is the usual
lowest-rank-first order.

A null or empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, worker_store
from .units import UnitCache, by_bytes

# The pre-token pattern of byte-level BPE.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Units that a worker keeps with their ids (about 450 bytes each).
CACHED_UNITS = 300_000

_NO_RANK = np.iinfo(np.int64).max
_SHIFT = 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    spare = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + i) for i, b in enumerate(spare)})
    return [letters[b] for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary from a tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.of_byte = np.array([vocab[c] for c in letters], dtype=np.int64)
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        keys = (left << _SHIFT) | right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        )
        self.pre_token = regex.compile(PRE_TOKEN)
        byte_of = {c: b for b, c in enumerate(letters)}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.added:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of every word (not empty)."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        out: list[np.ndarray] = [symbols[:0]] * len(words)
        while len(symbols):
            key = (symbols[:-1] << _SHIFT) | symbols[1:]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            rank = np.where(
                (self.keys[place] == key) & (word[:-1] == word[1:]), self.ranks[place], _NO_RANK
            )
            rank = np.append(rank, _NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(word)))
            done = lowest == _NO_RANK
            for w, a, n in zip(
                word[first[done]].tolist(), first[done].tolist(), count[done].tolist(), strict=True
            ):
                out[w] = symbols[a : a + n]
            hit = (rank == np.repeat(lowest, count)) & (rank != _NO_RANK)
            # Of overlapping hits (a run of one symbol) every second one holds, from the left.
            at = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit, 0, at + 1))
            hit &= (at - run_start) % 2 == 0
            symbols = np.where(hit, self.merged[np.where(hit, rank, 0)], symbols)
            keep = np.repeat(~done, count)
            keep[1:] &= ~hit[:-1]
            symbols, word = symbols[keep], word[keep]
        return out

    def encode_units(self, units: list[str]) -> list[tuple[bytes, str]]:
        """Per unit its ids as little-endian 32-bit integers and as decimals joined by commas."""
        number: dict[bytes, int] = {}
        plans: list[list[int]] = []
        for unit in units:
            plan = []
            parts = self.added_pattern.split(unit) if self.added_pattern else [unit]
            for part in parts:
                if part in self.added:
                    plan.append(-1 - self.added[part])
                else:
                    for piece in self.pre_token.findall(part):
                        plan.append(number.setdefault(piece.encode(), len(number)))
            plans.append(plan)
        ids = [x.astype("<u4").tobytes() for x in self.encode_words(list(number))] if number else []
        out = []
        for plan in plans:
            raw = b"".join(
                [ids[p] if p >= 0 else np.array([-1 - p], dtype="<u4").tobytes() for p in plan]
            )
            out.append((raw, ",".join(map(str, np.frombuffer(raw, dtype="<u4").tolist()))))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; byte runs that are not UTF-8 become replacement characters."""
        of = self.bytes_of
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join([of[i] for i in numbers]).decode("utf-8", errors="replace")


RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, tokenizer_path: str, texts_out: bool = False) -> DataFrame:
    """Encode every text, decode the ids again; digests of both per row of ``docs``.

    With ``texts_out`` also the ids (array) and the decoded text.  No shuffle.
    """
    schema = RESULT + (", ids array<bigint>, decoded string" if texts_out else "")

    def run(batches):
        model = worker_store(f"bpe:{tokenizer_path}", lambda: Bpe(tokenizer_path))
        cache = worker_store(
            f"bpe-units:{tokenizer_path}", lambda: UnitCache(model.encode_units, CACHED_UNITS)
        )
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            for part in by_bytes(texts):
                rows = []
                for key, values in zip(keys[part], cache.values(texts[part]), strict=True):
                    raw = b"".join([v[0] for v in values])
                    decimals = ",".join([v[1] for v in values])
                    decoded = model.decode(raw)
                    rows.append(
                        {
                            "doc_id": key,
                            "n_tokens": len(raw) // 4,
                            "ids_sha256": hashlib.sha256(decimals.encode()).hexdigest(),
                            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
                            "ids": np.frombuffer(raw, dtype="<u4").tolist() if texts_out else None,
                            "decoded": decoded if texts_out else None,
                        }
                    )
                fields = [
                    ("doc_id", pa.int64()),
                    ("n_tokens", pa.int64()),
                    ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string()),
                ]
                if texts_out:
                    fields += [("ids", pa.list_(pa.int64())), ("decoded", pa.string())]
                yield pa.RecordBatch.from_pylist(
                    [{n: r[n] for n, _ in fields} for r in rows], schema=pa.schema(fields)
                )

    return id_and_text(docs).mapInArrow(run, schema)
