"""Wide headline rows: split by date, clean, concatenate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_non_letters
from ..schemas import HEADLINE_COLUMNS, N_HEADLINES

# Date bounds of the hold-out split, and the text of a missing cell.
TRAIN_BEFORE = "20150101"
TEST_AFTER = "20141231"
MISSING = "nan"


def date_split(
    rows: DataFrame, typed: bool = False, column: str = "Date"
) -> tuple[DataFrame, DataFrame]:
    """(train, test).

    By default dates are compared as strings, so hyphenated dates of 2015 fall on both sides;
    ``typed`` compares parsed dates, where each row lands on one side.
    """
    if not typed:
        return rows.filter(F.col(column) < TRAIN_BEFORE), rows.filter(F.col(column) > TEST_AFTER)
    day = F.try_to_timestamp(F.replace(F.col(column), F.lit("-"), F.lit("")), F.lit("yyyyMMdd"))
    bound = F.to_timestamp(F.lit(TRAIN_BEFORE), "yyyyMMdd")
    return rows.filter(day < bound), rows.filter(day >= bound)


def headline_slice(rows: DataFrame, *keep: str) -> DataFrame:
    """The headline columns under the names "0", "1", ..., next to the columns to keep."""
    named = [F.col(c).alias(str(i)) for i, c in enumerate(HEADLINE_COLUMNS)]
    return rows.select(*keep, *named)


def clean_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Non-letters to blanks, then lower case."""
    return rows.withColumns({c: F.lower(strip_non_letters(c)) for c in columns})


def concat_columns(columns: list[str]) -> Column:
    """Columns joined by a blank; a missing one shows as ``nan``."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit(MISSING)) for c in columns])


def concat_headlines(rows: DataFrame, *keep: str, clean: bool) -> DataFrame:
    """One text per row out of its headline columns."""
    names = [str(i) for i in range(N_HEADLINES)]
    sliced = headline_slice(rows, *keep)
    return (clean_columns(sliced, names) if clean else sliced).select(
        *keep, concat_columns(names).alias("article")
    )


def train_and_test_texts(
    rows: DataFrame, *keep: str, clean_test: bool = False, typed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train text is cleaned; test text only on request, as in the evaluation being reproduced."""
    train, test = date_split(rows, typed)
    return (
        concat_headlines(train, *keep, clean=True),
        concat_headlines(test, *keep, clean=clean_test),
    )
