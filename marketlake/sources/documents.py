"""Raw document scan (S1): landed JSON responses -> one row per document.

Output schema: (item STRING, source_file STRING, date_key STRING, doc VARIANT,
is_object BOOLEAN).  The dataset is the folder right below the landing root;
folders of control files are excluded.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import EXCLUDED_SOURCE_DIRS

DATE_KEY_PATH = "$.crawlerdic.payload.date"

# Shape of a plain document as ``schema_of_variant`` writes it: one table of strings under the bare keys, the
# request's date, and single values under keys that name no block.  VOID, VARIANT and other types are not plain.
_SINGLE = r"(?:STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\(\d+,\d+\))"
_REQUEST = rf"crawlerdic: OBJECT<(?:\w+: {_SINGLE}, )*payload: OBJECT<(?:\w+: {_SINGLE}, )*date: STRING(?:, \w+: {_SINGLE})*>(?:, \w+: {_SINGLE})*>"
_BESIDE = rf"(?:{_REQUEST}|(?!(?:(?:sub)?title|fields|data|groups|notes|tables|credit\w*|crawlerdic)\d*: )\w+: {_SINGLE})"
PLAIN_SHAPE = (rf"\AOBJECT<(?:{_BESIDE}, )*data: ARRAY<ARRAY<STRING>>, (?:{_BESIDE}, )*fields: ARRAY<STRING>, "
               rf"(?:{_BESIDE}, )*title: STRING(?:, {_BESIDE})*>\z")
PLAIN_SHAPE_LENGTH = 1000
PLAIN_TABLE = "title string, fields array<string>, data array<array<string>>"

# Shape and content of a document of text tables: any number of tables of strings under the bare keys, under keys
# numbered up to 9 and in the elements of ``tables``; beside them what a plain document may have.
TABLE_SUFFIXES = ["", *map(str, range(1, 10))]
_ROWS = "ARRAY<(?:VOID|ARRAY<(?:STRING|VOID)>)>"
_OF_TABLE = rf"(?:(?:sub)?title{{0}}: STRING|fields{{0}}: ARRAY<STRING>|data{{0}}: {_ROWS})"
_OF_ELEMENT = rf"(?:{_OF_TABLE.format('')}|{_BESIDE})"
_OF_DOCUMENT = rf"(?:{_OF_TABLE.format('[1-9]?')}|{_BESIDE}|tables: ARRAY<OBJECT<{_OF_ELEMENT}(?:, {_OF_ELEMENT})*>>)"
TEXT_SHAPE = rf"\AOBJECT<{_OF_DOCUMENT}(?:, {_OF_DOCUMENT})*>\z"
TEXT_TABLES = ", ".join(f"title{n} string, subtitle{n} string, fields{n} array<string>, data{n} array<array<string>>"
                        for n in TABLE_SUFFIXES) + f", tables array<struct<{PLAIN_TABLE}>>"


def plain_table(json: Column, doc: Column) -> Column:
    """Title, fields and data of a plain document, read from its text in one pass; null for any other document.

    The shape of the whole VARIANT is checked first: where every cell is a string or null, the text and the VARIANT hold
    the same values, and the VARIANT need not be read cell by cell."""
    shape = F.schema_of_variant(doc)
    plain = (F.length(shape) <= PLAIN_SHAPE_LENGTH) & shape.rlike(PLAIN_SHAPE)
    return F.when(plain, F.from_json(json, PLAIN_TABLE))


def _finish_text(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """The output with the column ``text_tables``: the tables of a document of text tables, read from its text in one pass.

    The shape of the whole VARIANT is checked first (in a step of its own, it is used twice).  The shape of an array is that of
    all its elements together: an element of ``tables`` that lacks a member, or holds null there, is told by the null that was read."""
    shaped = df.select("item", "source_file", "json", "doc", F.schema_of_variant("doc").alias("shape"))
    fits = (F.length("shape") <= PLAIN_SHAPE_LENGTH) & F.col("shape").rlike(TEXT_SHAPE)
    out = shaped.select("item", "source_file", F.try_variant_get("doc", DATE_KEY_PATH, "string").alias("date_key"), "doc",
                        F.when(fits, F.from_json("json", TEXT_TABLES)).alias("read"))
    member = lambda name: F.col(f"read.{name}").isNotNull()
    some = functools.reduce(lambda a, b: a | b, [member(f"{role}{n}") for n in TABLE_SUFFIXES[:2] for role in ("title", "subtitle", "fields", "data")])
    whole = F.forall("read.tables", lambda t: t["title"].isNotNull() & t["fields"].isNotNull() & t["data"].isNotNull())
    good = some & F.coalesce(whole, F.lit(True))
    is_object = good | F.try_variant_get("doc", "$", "map<string,variant>").isNotNull()
    return _included(out.select("item", "source_file", "date_key", F.col("doc"), is_object.alias("is_object"),
                                F.when(good, F.col("read")).alias("text_tables")), exclude)


def _finish(df: DataFrame, exclude: Sequence[str], plain: bool = False, text_tables: bool = False) -> DataFrame:
    doc = F.try_parse_json(F.col("json"))  # malformed text: null, quarantined later as no object
    if text_tables:
        return _finish_text(df.select("item", "source_file", "json", doc.alias("doc")), exclude)
    if plain:
        return _finish_plain(df.select("item", "source_file", "json", doc.alias("doc")), exclude)
    out = df.select("item", "source_file", doc.alias("doc"))
    out = out.select(
        "item", "source_file",
        F.try_variant_get("doc", DATE_KEY_PATH, "string").alias("date_key"),
        "doc",
        F.try_variant_get("doc", "$", "map<string,variant>").isNotNull().alias("is_object"))
    return _included(out, exclude)


def _finish_plain(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """The output with the column ``plain``; plain documents are objects without a look at their keys."""
    out = df.select("item", "source_file", "doc", plain_table(F.col("json"), F.col("doc")).alias("plain"))
    is_object = F.col("plain").isNotNull() | F.try_variant_get("doc", "$", "map<string,variant>").isNotNull()
    out = out.select("item", "source_file", F.try_variant_get("doc", DATE_KEY_PATH, "string").alias("date_key"), "doc",
                     is_object.alias("is_object"), "plain")
    return _included(out, exclude)


def _included(docs: DataFrame, exclude: Sequence[str]) -> DataFrame:
    return docs.where(~F.col("item").isin(list(exclude))) if exclude else docs


def read_landed_documents(spark: SparkSession, root: str, suffix: str = ".json",
                          exclude: Sequence[str] = EXCLUDED_SOURCE_DIRS) -> DataFrame:
    """Whole-file JSON text below ``root/<item>/...``; one task per file split,
    no driver-side listing loop."""
    root = root.rstrip("/")
    raw = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", f"*{suffix}").text(root))
    path = F.col("_metadata.file_path")
    rel = F.regexp_replace(path, r"^.*?" + _regex_escape(root.split("://")[-1]) + "/", "")
    df = raw.select(F.regexp_extract(rel, r"^([^/]+)/", 1).alias("item"), path.alias("source_file"),
                    F.col("value").alias("json"))
    return _finish(df.where(F.col("item") != ""), exclude)


def documents_from_text(df: DataFrame, exclude: Sequence[str] = EXCLUDED_SOURCE_DIRS, plain: bool = False,
                        text_tables: bool = False) -> DataFrame:
    """Same output from a frame that already holds (item, source_file, json).  With ``plain``, the column
    ``plain`` besides: the table of documents that hold one and nothing else (``plain_table``).  With ``text_tables``,
    the column ``text_tables`` besides: all tables of documents that hold tables of strings only."""
    return _finish(df.select("item", "source_file", "json"), exclude, plain, text_tables)


def _regex_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)
