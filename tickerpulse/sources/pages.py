"""Stored web pages: title and body text, and topic search over them."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

# Names of the HTML standard with their characters; a few also count without the semicolon.
_SHORT_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_SHORT = f"^(?:{'|'.join(_SHORT_NAMES)})"
_NAMED = "^[A-Za-z][A-Za-z0-9]*;"
_DECIMAL = "^#([0-9]+);?"
_HEX = "^#[xX]([0-9a-fA-F]+);?"
_LOST = "\ufffd"

TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
# What a browser does not show as text: comments and the contents of these elements, closed or not.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\z)"
# Elements around an article.
AROUND = r"(?is)<(title|nav|footer|aside)\b[^>]*>.*?(?:</\1\s*>|\z)"
# In front of every tag of an article element; other names may begin alike.
ARTICLE_TAG = r"(?i)(?=</?article[\s/>])"
# Tags that begin or end a block of text.
BLOCK_TAG = (
    r"(?i)</?(?:address|article|blockquote|body|br|center|dd|div|dl|dt|fieldset|figcaption|figure|"
    r"form|h[1-6]|head|header|hr|html|li|main|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|"
    r"thead|tr|ul)\b[^>]*>"
)
LINK = r"(?is)<a\b[^>]*>.*?(?:</a\s*>|\z)"
# A block counts its words outside links, less three for a word in a link, one for a tag and this.
BLOCK_COST = 15
LANGUAGE = '(?i)<html[^>]* lang="([a-z]+)'


def _table(pairs: dict[str, str]) -> Column:
    """A constant map; the optimizer builds it once."""
    text = "\x01".join(f"{k}\x02{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def _character(number: Column) -> Column:
    """The character of a numeric reference; 128 to 159 are read as Windows-1252."""
    old = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
    point = number.try_cast("long")
    lost = point.isNull() | (point == 0) | (point > 0x10FFFF) | point.between(0xD800, 0xDFFF)
    wide = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    known = F.when(point.between(128, 159), F.element_at(_table(old), point.cast("string")))
    return F.when(lost, _LOST).otherwise(F.coalesce(known, wide))


def _decode_reference(piece: Column) -> Column:
    """``piece`` is what follows an ampersand."""
    decimal, hexa = F.regexp_extract(piece, _DECIMAL, 0), F.regexp_extract(piece, _HEX, 0)
    named, short = F.regexp_extract(piece, _NAMED, 0), F.regexp_extract(piece, _SHORT, 0)
    names = _table(html5)
    found = [
        (decimal, F.when(decimal != "", _character(F.regexp_extract(piece, _DECIMAL, 1)))),
        (hexa, F.when(hexa != "", _character(F.conv(F.regexp_extract(piece, _HEX, 1), 16, 10)))),
        (named, F.element_at(names, named)),
        (short, F.element_at(names, short)),
    ]
    # A hard blank becomes a plain one.
    return F.coalesce(
        *(
            F.concat(F.replace(char, F.lit("\xa0"), F.lit(" ")), F.substr(piece, F.length(ref) + 1))
            for ref, char in found
        ),
        F.concat(F.lit("&"), piece),
    )


def decode_entities(text: Column) -> Column:
    """Named and numeric references decoded, each once."""

    def joined(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _decode_reference)
        return F.concat(F.element_at(pieces, 1), F.concat_ws("", rest))

    return let(
        text, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), joined)).otherwise(t)
    )


def plain_text(html: Column) -> Column:
    """Tags out, entities decoded, white space squeezed."""
    text = decode_entities(F.regexp_replace(html, "<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, r"[ \t\n\f\r]+", " "))


def page_title(html: Column | str) -> Column:
    return plain_text(F.regexp_extract(html, TITLE, 1))


def article_html(visible: Column) -> Column:
    """What stands inside article elements, null if there is none.

    The page is cut in front of every article tag and the pieces are walked with the depth at hand:
    articles may be nested, and one that is never closed ends with the page.
    """

    def step(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)\A<article[\s/>]"), piece.rlike(r"(?i)\A</article[\s/>]")
        depth = F.when(opens, state["depth"] + 1).when(
            closes, F.greatest(state["depth"] - 1, F.lit(0))
        ).otherwise(state["depth"])
        return let(
            depth,
            lambda d: F.struct(
                d.alias("depth"),
                (state["found"] | opens).alias("found"),
                F.when(d > 0, F.concat(state["html"], F.lit(" "), piece)).otherwise(state["html"]).alias("html"),
            ),
        )

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("found"), F.lit("").alias("html")
    )
    return F.aggregate(
        F.split(visible, ARTICLE_TAG), start, step, lambda end: F.when(end["found"], end["html"])
    )


def block_score(block: Column) -> Column:
    """How much a block looks like running text: many words, few tags, few of them in links."""
    words = r"[^ \t\n\f\r]+"

    def count(html: Column) -> Column:
        return F.regexp_count(F.regexp_replace(html, "<[^>]*>", " "), F.lit(words))

    outside = count(F.regexp_replace(block, LINK, " "))
    tags = F.length(block) - F.length(F.replace(block, F.lit("<"), F.lit("")))
    score = let(
        F.struct(outside.alias("outside"), count(block).alias("all")),
        lambda n: F.when(n["all"] > 0, 4 * n["outside"] - 3 * n["all"] - tags - BLOCK_COST),
    )
    # Between neighbouring tags there is nothing to judge.
    return F.coalesce(score, F.lit(0))


def main_blocks(visible: Column) -> Column:
    """The run of blocks with the largest sum of scores, null if no block has a positive one.

    The first of equal runs counts, and of those that end together the shortest.
    """

    def step(state: Column, score: Column) -> Column:
        goes_on = state["sum"] > 0
        total = F.greatest(state["sum"], F.lit(0)) + score
        start = F.when(goes_on, state["start"]).otherwise(state["i"])
        better = total > state["best"]
        return F.struct(
            (state["i"] + 1).alias("i"),
            total.alias("sum"),
            start.alias("start"),
            F.when(better, total).otherwise(state["best"]).alias("best"),
            F.when(better, start).otherwise(state["from"]).alias("from"),
            F.when(better, state["i"]).otherwise(state["to"]).alias("to"),
        )

    names = ("i", "sum", "start", "best", "from", "to")

    def run(blocks: Column) -> Column:
        found = F.aggregate(
            F.transform(blocks, block_score), F.struct(*[F.lit(0).alias(n) for n in names]), step
        )
        return let(
            found,
            lambda f: F.when(
                f["best"] > 0,
                F.array_join(F.slice(blocks, f["from"] + 1, f["to"] - f["from"] + 1), " "),
            ),
        )

    return let(F.split(F.regexp_replace(visible, AROUND, " "), BLOCK_TAG), run)


def page_body(html: Column | str, fallback: bool = True) -> Column:
    """Text of all article elements.

    A page without any has the text of its main blocks, found by their density of text and links;
    null where these show no running text either (or with ``fallback`` off), so the fetch counts as
    failed.
    """
    source = F.col(html) if isinstance(html, str) else html

    def body(visible: Column) -> Column:
        article = article_html(visible)
        return let(
            F.coalesce(article, main_blocks(visible)) if fallback else article, plain_text
        )

    return let(F.regexp_replace(source, HIDDEN, " "), body)


def page_language(html: Column | str) -> Column:
    return F.regexp_extract(html, LANGUAGE, 1)


def strip_blanks(c: Column | str) -> Column:
    """Text without white space of any kind around it."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def extract_pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        strip_blanks("url").alias("url"),
        page_title("html").alias("title"),
        page_body("html").alias("article"),
    )


def extract_titles(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", page_title("html").alias("title"))


def hits_from_pages(pages: DataFrame, newest: str) -> DataFrame:
    """A table of search hits made from stored pages.

    The rank is the page number.  Pages carry no date, so one within the two weeks before
    ``newest`` is derived from the length of the page.
    """
    age = F.make_dt_interval(hours=(F.length("html") % 336).cast("int"))
    return pages.select(
        F.col("page_id").alias("rank"),
        page_title("html").alias("title"),
        "url",
        page_language("html").alias("lang"),
        (F.lit(newest).cast("timestamp_ntz") - age).alias("ts"),
    )


def recent(as_of: str, days: int = 7) -> Column:
    """Within ``days`` before ``as_of``; the moment is explicit so that a rerun finds the same."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return (F.col("ts") >= end - F.make_dt_interval(days=F.lit(days))) & (F.col("ts") <= end)


def matching_hits(
    hits: DataFrame, topic: str | None, as_of: str, language: str = "en", days: int = 7
) -> DataFrame:
    """Hits in one language, inside the recency window, that mention the topic in the title."""
    found = hits.filter((F.col("lang") == language) & recent(as_of, days))
    if topic is None:
        return found
    return found.filter(F.contains(F.lower("title"), F.lit(topic.lower())))
