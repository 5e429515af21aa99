"""Plain versions of the operators' contracts, for small tables."""

import itertools
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    words = SPACE.findall(lower(text or ""))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(rows, width, percent=80):
    """{doc_id: (n_shingles, smallest linked doc_id)} by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), find(i)) for i in sets}


def quality_counts(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in "".join(words)),
        dup,
        len(inside),
    )


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    ("cc", "by"): "cc-by",
    ("general", "public", "license"): "gpl",
    ("all", "rights", "reserved"): "reserved",
}


def license_base(text):
    words = LICENSE_WORD.findall(lower(text or ""))
    places = [
        (i, label)
        for i in range(len(words))
        for phrase, label in PHRASES.items()
        if tuple(words[i : i + len(phrase)]) == phrase
    ]
    at = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def line_dedup(rows):
    """{doc_id: text} without later occurrences of three-line windows; ids are distinct."""
    first, gone = {}, {i: set() for i, _ in rows}
    lines = {i: t.split("\n") for i, t in rows if t is not None}
    for i in sorted(lines):
        for p in range(len(lines[i]) - 2):
            window = tuple(lines[i][p : p + 3])
            if not re.search(r"[^ \t\r\f\n]", "".join(window)):
                continue
            home = first.setdefault(window, (i, p))
            if home != (i, p):
                start = max(p, home[1] + 3) if home[0] == i else p
                gone[i].update(range(start, p + 3))
    return {
        i: None
        if t is None
        else "\n".join(x for p, x in enumerate(lines[i]) if p not in gone[i])
        for i, t in rows
    }


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
