"""Cleaning, tokenizing and n-grams as built-in column expressions.

Everything here is null-safe: a null text gives a null result, never an error, so one bad message
cannot stop a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
KEPT_RUN = r"[a-zA-Z0-9\s]+"
# Characters Java's \s stands for.
BLANKS = " \t\n\x0b\f\r"

# Unicode script names, commonest in news text first.
SCRIPTS = (
    "Latin Common Inherited Cyrillic Greek Han Hiragana Katakana Hangul Arabic Hebrew Devanagari "
    "Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Thai Lao Tibetan "
    "Myanmar Georgian Armenian Ethiopic Khmer Mongolian Bopomofo Yi Cherokee Canadian_Aboriginal "
    "Syriac Thaana Ogham Runic Tagalog Hanunoo Buhid Tagbanwa Limbu Tai_Le New_Tai_Lue Buginese "
    "Tai_Tham Balinese Sundanese Batak Lepcha Ol_Chiki Glagolitic Coptic Tifinagh Syloti_Nagri "
    "Phags_Pa Saurashtra Kayah_Li Rejang Javanese Cham Tai_Viet Meetei_Mayek Gothic Deseret Nko "
    "Vai Bamum Lisu Samaritan Mandaic Chakma Braille"
).split()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_non_letters(c: Column | str) -> Column:
    """Every character outside a-z, A-Z becomes one blank."""
    return F.regexp_replace(_col(c), "[^a-zA-Z]", " ")


def normalize(c: Column | str) -> Column:
    """Lower-case, then delete everything but ASCII letters, digits and white space.

    Joining the runs to keep gives what replacing the other characters gives; Java's matcher is
    several times faster on long runs than on looking for rare single characters.
    """
    return F.array_join(F.regexp_extract_all(F.lower(_col(c)), F.lit(KEPT_RUN), F.lit(0)), "")


def first_line(c: Column | str) -> Column:
    return F.substring_index(_col(c), "\n", 1)


def tokens_whitespace(c: Column | str) -> Column:
    """Lower-case and split at each white-space character.

    Empty tokens inside and in front stay, those at the end go; an empty text is one empty token
    and a text of blanks only has none.
    """
    text = F.lower(_col(c))
    trimmed = F.rtrim(text, F.lit(BLANKS))
    only_blanks = (trimmed == "") & (text != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s"))


def tokens_word(c: Column | str) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores, in any script."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD_PATTERN), F.lit(0))


def words_sql(c: str) -> str:
    """``tokens_word`` as SQL text, for stages that are saved with a model."""
    return f"regexp_extract_all(lower({c}), r'{WORD_PATTERN}', 0)"


def normalize_sql(c: str) -> str:
    """``normalize`` as SQL text."""
    return f"array_join(regexp_extract_all(lower({c}), r'{KEPT_RUN}', 0), '')"


def bigrams_sql(c: str) -> str:
    """``bigrams`` as SQL text."""
    return (
        f"transform(array({c}), t -> zip_with(slice(t, 1, greatest(size(t) - 1, 0)), "
        "slice(t, 2, greatest(size(t) - 1, 0)), (a, b) -> concat(a, ' ', b)))[0]"
    )


def script_pattern(scripts: Iterable[str] = SCRIPTS) -> str:
    """One run of a script.  White space, which belongs to "Common", is ruled out before the
    alternatives are tried, and ASCII letters need no script lookup."""
    runs = {
        "Latin": r"[a-zA-Z\p{IsLatin}]+",
        "Common": r"[^\P{IsCommon}\s\p{Z}\x{85}]+",
    }
    return r"(?=[^\s\p{Z}\x{85}])(?:" + "|".join(
        runs.get(name, rf"\p{{Is{name}}}+") for name in scripts
    ) + r"|[^\s\p{Z}\x{85}])"


def tokens_script(c: Column | str, scripts: Iterable[str] = SCRIPTS) -> Column:
    """Split at white space and wherever the Unicode script changes.

    Digits, punctuation and symbols share the script "Common", so a run of them is one token.
    A character of any other script, or newer than the tables of the JVM, is a token by itself.
    """
    return F.regexp_extract_all(_col(c), F.lit(script_pattern(scripts)), F.lit(0))


def drop_words(tokens: Column | str, words: Iterable[str], case_sensitive: bool = False) -> Column:
    """Remove listed words.  ``isin`` over literals is a hash-set probe, not a list scan."""
    listed = list(words) if case_sensitive else [w.lower() for w in words]
    if not listed:
        return _col(tokens)
    fold = (lambda w: w) if case_sensitive else F.lower
    return F.filter(_col(tokens), lambda w: ~fold(w).isin(listed))


def bigrams(tokens: Column | str) -> Column:
    """Neighbouring tokens joined by a blank; fewer than two tokens give an empty array."""

    def pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.zip_with(
            F.slice(t, F.lit(1), n), F.slice(t, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)
        )

    return let(_col(tokens), pairs)


def truncate(tokens: Column | str, max_len: int = 512) -> Column:
    """The first ``max_len`` tokens, as a model with a fixed input length takes them."""
    return F.slice(_col(tokens), 1, max_len)


def term_counts(terms: Column | str) -> Column:
    """Array of ``(term, tf)`` of one document.

    A document is one row, so its counts need no shuffle: sort its terms, note where each run
    starts, and measure the runs.
    """

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.transform(
                s, lambda x, i: F.when((i == 0) | ~x.eqNullSafe(F.get(s, i - 1)), i)
            ),
            lambda p: p.isNotNull(),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(s)) - p).cast("bigint").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(_col(terms)), runs)
