"""Porter stemming as column expressions (M. F. Porter, "An algorithm for suffix stripping", 1980).

Each step of the paper is one pass over an array of words: find the longest listed ending, then
rewrite it if what precedes it is long enough.  Words of one or two letters stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# A consonant run and a vowel run; "y" is a vowel after a consonant, so never at the start.
_CONS = "[^aeiou][^aeiouy]*"
_VOW = "[aeiouy][aeiou]*"
_START = f"^(?:{_CONS}{_VOW}|[aeiou]+)"
M_POSITIVE = f"{_START}{_CONS}"
M_ONE = f"{_START}{_CONS}(?:{_VOW})?$"
M_OVER_ONE = f"{_START}{_CONS}{_VOW}{_CONS}"
HAS_VOWEL = f"^(?:{_CONS}[aeiouy]|[aeiou])"
# Ends consonant, vowel, consonant, where the last one is not w, x or y.
ENDS_CVC = f"^{_CONS}[aeiouy][^aeiouwxy]$"

# Endings and replacements of steps 2, 3 and 4 of the paper.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize"
).split()


def ending_pattern(endings) -> str:
    """Longest ending first, so that the leftmost match is the one the paper asks for."""
    return "(" + "|".join(sorted(endings, key=len, reverse=True)) + ")$"


def _step(
    words: Column, pattern: str, tails: set[str], rewrite: Callable[[Column, Column], Column]
) -> Column:
    """Each word with a listed ending becomes ``rewrite(stem, ending)``.

    ``tails`` are the last letters the endings can have.  Most words have others and are passed
    on after a set probe.
    """
    n = len(next(iter(tails)))

    def one(w: Column) -> Column:
        def cut(end: Column) -> Column:
            stem = F.substring(w, F.lit(1), F.length(w) - F.length(end))
            return F.when(end == "", w).otherwise(let(stem, lambda s: rewrite(s, end)))

        possible = F.substring(w, -n, n).isin(sorted(tails))
        return F.when(~possible, w).otherwise(let(F.regexp_extract(w, pattern, 1), cut))

    return F.transform(words, one)


def _table_step(words: Column, endings: dict[str, str], condition: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in endings.items() for x in pair])

    def rewrite(stem: Column, end: Column) -> Column:
        return F.concat(
            stem, F.when(stem.rlike(condition), F.try_element_at(table, end)).otherwise(end)
        )

    return _step(words, ending_pattern(endings), {e[-2:] for e in endings}, rewrite)


def _step_1a(words: Column) -> Column:
    return F.transform(
        words,
        lambda w: F.when(~w.endswith("s"), w)
        .when(w.rlike("(ss|i)es$"), F.regexp_replace(w, "es$", ""))
        .otherwise(F.regexp_replace(w, "([^s])s$", "$1")),
    )


def _step_1b(words: Column) -> Column:
    def rewrite(stem: Column, end: Column) -> Column:
        double = (
            stem.rlike("[^aeiouylsz]$")
            & (F.substring(stem, -1, 1) == F.substring(stem, -2, 1))
            & (F.length(stem) > 1)
        )
        tidied = (
            F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(double, F.substring(stem, F.lit(1), F.length(stem) - 1))
            .when(stem.rlike(ENDS_CVC), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )
        return (
            F.when((end == "eed") & stem.rlike(M_POSITIVE), F.concat(stem, F.lit("ee")))
            .when((end != "eed") & stem.rlike(HAS_VOWEL), tidied)
            .otherwise(F.concat(stem, end))
        )

    return _step(words, "(eed|ed|ing)$", {"ed", "ng"}, rewrite)


def _step_1c(words: Column) -> Column:
    def rewrite(stem: Column, end: Column) -> Column:
        return F.concat(stem, F.when(stem.rlike(HAS_VOWEL), F.lit("i")).otherwise(end))

    return _step(words, "(y)$", {"y"}, rewrite)


def _step_4(words: Column) -> Column:
    def rewrite(stem: Column, end: Column) -> Column:
        return F.when(stem.rlike(M_OVER_ONE), stem).otherwise(F.concat(stem, end))

    # "ion" goes only after s or t, which is tested as part of the ending.
    pattern = "(" + "|".join(sorted(STEP_4, key=len, reverse=True)) + "|(?<=[st])ion)$"
    return _step(words, pattern, {e[-2:] for e in [*STEP_4, "ion"]}, rewrite)


def _step_5(words: Column) -> Column:
    def drop_e(stem: Column, end: Column) -> Column:
        drop = stem.rlike(M_OVER_ONE) | (stem.rlike(M_ONE) & ~stem.rlike(ENDS_CVC))
        return F.when(drop, stem).otherwise(F.concat(stem, end))

    def single_l(w: Column) -> Column:
        return F.when(
            w.endswith("ll") & w.rlike(M_OVER_ONE), F.substring(w, F.lit(1), F.length(w) - 1)
        ).otherwise(w)

    return F.transform(_step(words, "(e)$", {"e"}, drop_e), single_l)


def stem_words(words: Column | str) -> Column:
    """Stems of an array of lower-case words, in place."""
    source = F.col(words) if isinstance(words, str) else words
    stemmed = _step_1c(_step_1b(_step_1a(source)))
    stemmed = _table_step(stemmed, STEP_2, M_POSITIVE)
    stemmed = _table_step(stemmed, STEP_3, M_POSITIVE)
    stemmed = _step_5(_step_4(stemmed))
    return F.zip_with(
        source, stemmed, lambda w, s: F.when(F.length(w) <= 2, w).otherwise(s)
    )


def stem_word(word: Column | str) -> Column:
    source = F.col(word) if isinstance(word, str) else word
    return F.get(stem_words(F.array(source)), F.lit(0))
