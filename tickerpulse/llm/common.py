"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def id_and_text(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Only the two columns an operator needs, under fixed names, and the columns ``keep``; a null
    text is empty."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *keep,
    )


def worker_store(name: str, make: Callable[[], Any]) -> Any:
    """An object that one Python worker process keeps between tasks, such as a word cache."""
    home = sys.modules.setdefault("_tickerpulse_worker", types.ModuleType("_tickerpulse_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
