"""License scans: ordered signature rules over the words of a text.

A text becomes its words, in lower case, parted by single blanks.  A rule is a regular expression
over that line with a label, a priority and a keyword; only rules whose keyword the line holds
are tried.  Over two hundred are written by hand (``license_signatures``); others put the names of
license families together with what leads to them and their versions.  Of overlapping detections one that lies inside another of at least its priority is
suppressed, so "mit license" inside "released under the mit license" counts once.

Base phrases are looked for besides, all their places are counted and their labels always stay.

Null and empty texts have no words, no places and score 0.  Repeated rows are scanned each by
itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text
from .license_signatures import SIGNATURES as HAND_WRITTEN

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Fixed values: (label, keyword that every name holds, names of the license as words, versions).
FAMILIES = [
    ("mit", "mit", ["mit license", "mit licence", "mit x11 license"], []),
    ("mit", "expat", ["expat license"], []),
    ("apache", "apache", ["apache license", "apache software license"], ["1 0", "1 1", "2 0"]),
    ("apache", "asl", ["asl"], ["1 0", "1 1", "2 0"]),
    ("bsd", "bsd", ["bsd license", "bsd style license"],
     ["2 clause", "3 clause", "4 clause", "simplified", "new"]),
    ("bsd", "berkeley", ["berkeley software distribution license"],
     ["2 clause", "3 clause", "4 clause", "simplified", "new"]),
    ("gpl", "general public", ["gnu general public license", "general public license"],
     ["1", "1 0", "2", "2 0", "3", "3 0"]),
    ("gpl", "gpl", ["gnu gpl", "gpl license", "gpl"], ["1", "1 0", "2", "2 0", "3", "3 0"]),
    ("lgpl", "lesser general", ["gnu lesser general public license",
     "lesser general public license"], ["2 1", "3", "3 0"]),
    ("lgpl", "lgpl", ["gnu lgpl", "lgpl"], ["2", "2 0", "2 1", "3", "3 0"]),
    ("agpl", "affero", ["gnu affero general public license", "affero general public license"],
     ["1 0", "3", "3 0"]),
    ("mpl", "mozilla", ["mozilla public license"], ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", ["eclipse public license", "eclipse distribution license"], ["1 0", "2 0"]),
    ("cddl", "common development", ["common development and distribution license"],
     ["1 0", "1 1"]),
    ("cc-by", "cc by", ["cc by"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "creative commons", ["creative commons attribution license",
     "creative commons attribution"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "sa", ["cc by sa"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "creative commons", ["creative commons attribution sharealike",
     "creative commons attribution share alike"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "nc", ["cc by nc", "cc by nc sa", "cc by nc nd"], ["2 0", "3 0", "4 0"]),
    ("cc0", "cc0", ["cc0", "cc0 public domain dedication"], ["1 0"]),
    ("public-domain", "public domain", ["public domain"], []),
    ("isc", "isc", ["isc license"], []),
    ("zlib", "zlib", ["zlib license", "zlib libpng license"], []),
    ("unlicense", "unlicense", ["unlicense"], []),
    ("boost", "boost", ["boost software license"], ["1 0"]),
    ("artistic", "artistic", ["artistic license"], ["1 0", "2 0"]),
    ("proprietary", "proprietary", ["proprietary license", "proprietary and confidential"], []),
]
# Further signatures (label, keyword, pattern, priority).
SIGNATURES = [
    ("mit", "permission is hereby granted",
     r"permission is hereby granted free of charge to any person obtaining a copy", 9),
    ("bsd", "redistribution and use",
     r"redistribution and use in source and binary forms with or without modification", 9),
    ("apache", "apache", r"apache org licenses license(?: [0-9]){0,2}", 6),
    ("gpl", "gnu org", r"gnu org licenses gpl(?: [0-9]){0,2}", 6),
    ("gpl", "free software",
     r"free software you can redistribute it and or modify it under the terms", 9),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software", 9),
    ("reserved", "rights reserved", r"(?:all|some) rights reserved", 5),
    ("reserved", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: [0-9]{4})? [^ ]+(?: [^ ]+)? all rights reserved", 7),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 2),
    ("spdx", "spdx", r"spdx license identifier [^ ]+(?: [0-9]+){0,2}(?: only| or later)?", 8),
]
#: Names that are words of their own and count only after a lead, with a version or a license word.
AMBIGUOUS = {"asl"}
LEADS = ["", "(?:released|licensed|distributed|available|published) under (?:the |a )?",
         "under the terms of the ", "subject to the "]

_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int


def rules() -> list[Rule]:
    """Rules of families, the strongest first: names with every lead and version, and signatures."""
    made = []
    for label, keyword, names, versions in FAMILIES:
        for name in names:
            for k, lead in enumerate(LEADS):
                forms = [name, *(f"{name} (?:version |v)?{v}" for v in versions),
                         *(f"{v} {name}" for v in versions if not v[0].isdigit() or "clause" in v)]
                if name in AMBIGUOUS and not lead:
                    forms[0] = f"{name} license"
                for j, form in enumerate(forms):
                    made.append((label, keyword, lead + form, 3 + (k > 0) + 2 * (j > 0)))
    return _compiled(made + SIGNATURES)


def hand_written() -> list[Rule]:
    """Rules of the hand-written signatures, the strongest first."""
    return _compiled(HAND_WRITTEN)


def _compiled(rows: list[tuple[str, str, str, int]]) -> list[Rule]:
    return [
        Rule(label, f" {keyword} ".encode() if len(keyword) < 4 else keyword.encode(),
             re.compile(f"(?<= )(?:{pattern})(?= )".encode()), priority)
        for label, keyword, pattern, priority in sorted(rows, key=lambda r: (-r[3], r[0], r[2]))
    ]


def by_keyword() -> dict[bytes, list[Rule]]:
    out: dict[bytes, list[Rule]] = {}
    for rule in rules() + hand_written():
        out.setdefault(rule.keyword, []).append(rule)
    return out


def line_of(text: str) -> tuple[bytes, int]:
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split()
    return b" " + b" ".join(words) + b" ", len(words)


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(word number, label) of all places of base phrases."""
    out = []
    for phrase, label in BASE.items():
        needle = b" " + phrase.encode() + b" "
        at = line.find(needle)
        while at >= 0:
            out.append((line.count(b" ", 0, at), label))
            at = line.find(needle, at + 1)
    return sorted(out)


def keyword_finder(keywords: list[bytes]) -> Callable[[bytes], set[bytes]]:
    """A function of a line to the keywords it holds, all looked for in one pass."""
    automaton = ahocorasick.Automaton()
    for keyword in keywords:
        # One character a byte.
        automaton.add_word(keyword.decode("latin-1"), keyword)
    automaton.make_automaton()
    return lambda line: {keyword for _, keyword in automaton.iter(line.decode("latin-1"))}


def detections(
    line: bytes, gated: dict[bytes, list[Rule]], held: set[bytes] | None = None
) -> list[tuple[int, int, Rule]]:
    """Surviving (start, end, rule), by place in the line; ``held`` are its keywords, if known."""
    if held is None:
        held = {keyword for keyword in gated if keyword in line}
    found = [
        (m.start(), m.end(), rule)
        for keyword in held
        for rule in gated[keyword]
        for m in rule.pattern.finditer(line)
    ]
    # By start, longest first: whatever holds a detection stands before it.
    found.sort(key=lambda d: (d[0], -d[1], -d[2].priority, d[2].label))
    kept: list[tuple[int, int, Rule]] = []
    reach: dict[int, int] = {}  # furthest end so far of detections of a priority or more
    for start, end, rule in found:
        if reach.get(rule.priority, -1) < end:
            kept.append((start, end, rule))
            for p in range(rule.priority + 1):
                reach[p] = max(reach.get(p, -1), end)
    return kept


RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, n_detections bigint"
)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: words, base places, labels, and a score of how surely it is licensed.

    The score is one less the product of (1 - priority / 10) over the surviving detections, base
    places counting as priority 5.  No shuffle.
    """

    def run(batches):
        gated = by_keyword()
        find = keyword_finder(list(gated))
        fields = [
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
            ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
            ("labels", pa.string()), ("score", pa.float64()), ("n_detections", pa.int64()),
        ]
        for batch in batches:
            rows = []
            for key, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                line, n = line_of(text)
                places = base_places(line)
                found = detections(line, gated, find(line))
                own = {label for _, label in places}
                doubt = 1.0
                for strength in [r.priority for _, _, r in found] + [5] * len(places):
                    doubt *= 1 - strength / 10
                rows.append((
                    key, n, len(places),
                    places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(sorted(own)),
                    ",".join(sorted(own | {r.label for _, _, r in found})),
                    1 - doubt, len(found),
                ))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)],
                names=[f for f, _ in fields],
            )

    return id_and_text(docs).mapInArrow(run, RESULT)
