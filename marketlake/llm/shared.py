"""Helpers of the training-data operators: scratch tables in the shared folder, names, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import ensure_checkpoint_dir

# a word is a run of anything but the six ASCII blanks
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks it was running.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that derived columns cannot clash with them."""
    return F.struct(*[col(c) for c in df.columns])


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
