"""Semi-structured extraction: raw documents -> sub-tables -> typed frames
(X1-X8, P1-P6, N3-N6, Q4).

Everything per document runs on executors: object keys are exploded from the
VARIANT, numbered blocks are regrouped by a (tiny, per document) group-by,
rows are exploded and cells picked by header position.  The only values that
reach the driver are the final column names of each sub-table - schema
metadata, comparable to JSON schema inference - because Spark needs the output
columns at plan time.
"""

from __future__ import annotations

from collections.abc import Sequence
import functools
import statistics
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalog
from ..functions import scalars as S
from ..functions.date_labels import let
from ..sources.documents import TABLE_SUFFIXES
from . import headers

IDS = ["item", "source_file", "date_key"]
ROLES = ("title", "fields", "data", "groups", "notes")
KIND_MAIN, KIND_CREDIT, KIND_LEGACY = "main", "credit", "legacy"


class DataCleanError(Exception):
    """Contextual data error (Q4)."""

    def __init__(self, message: str, **ctx):
        self.context = {k: v for k, v in ctx.items() if v is not None}
        detail = ", ".join(f"{k}={v!r}" for k, v in self.context.items())
        super().__init__(f"{message} ({detail})" if detail else message)


#: the context of a quarantined error
ERROR_FIELDS = ("message", "file", "item", "subitem", "column", "value", "value_type", "date", "hint")


def error_struct(message, file=None, item=None, subitem=None, column=None, value=None, value_type=None, date=None,
                 hint=None) -> Column:
    def lit_or_col(x):
        if x is None:
            return F.lit(None).cast("string")
        return x.cast("string") if isinstance(x, Column) else F.lit(str(x))
    given = (message, file, item, subitem, column, value, value_type, date, hint)
    return F.struct(*[lit_or_col(x).alias(name) for name, x in zip(ERROR_FIELDS, given)])


def raise_first_error(errors: DataFrame) -> None:
    """Strict mode: raise the first quarantined error, if any (one row fetched)."""
    first = errors.select("error.*").limit(1).collect()
    if first:
        r = first[0].asDict()
        raise DataCleanError(r.pop("message"), **r)


# X1 / X2 / X5 -------------------------------------------------------------
# All block logic runs inside each document row with higher-order functions:
# no shuffle regroups document content, whatever the number of documents.
# Values are read from the VARIANT where the block is built: as columns after the explode they
# would be read again by every filter that is pushed below them.
ROLE_TYPES = {"title": "string", "fields": "array<string>", "data": "array<array<string>>", "groups": "string",
              "notes": "string"}
_BLOCK_ARRAY = ("array<struct<container:int,kind:string,k:bigint,"
                + ",".join(f"{role}:{kind}" for role, kind in ROLE_TYPES.items()) + ">>")


def _no_blocks() -> Column:
    return F.array().cast(_BLOCK_ARRAY)


def _suffix_numbers(m: Column, pattern: str, bare: int | None = None) -> Column:
    """Sorted distinct numbers at the end of the keys that fit ``pattern`` (group 1);
    a key without a number counts as ``bare``, a number beyond BIGINT is no block."""
    found = F.transform(F.filter(F.map_keys(m), lambda x: x.rlike(pattern)),
                        lambda x: F.regexp_extract(x, pattern, 1))
    numbers = F.transform(found, lambda x: F.when(x == "", F.lit(bare).cast("bigint")).otherwise(x.try_cast("bigint")))
    return F.sort_array(F.array_distinct(F.filter(numbers, lambda k: k.isNotNull())))


def _main_block_keys(m: Column) -> Column:
    """Numbers of the main blocks: 0 and 1 may be missing, from 2 on the
    numbering stops at the first gap (the n-th number from 2 on must be n + 2)."""
    aliases = [a for names in catalog.MAIN_BLOCK_ALIASES.values() for a in names]
    return let(_suffix_numbers(m, "^(?:" + "|".join(aliases) + ")([1-9][0-9]*|)$", bare=0), lambda ks: F.concat(
        F.filter(ks, lambda k: k < 2), F.filter(F.filter(ks, lambda k: k >= 2), lambda k, i: k == i + 2)))


def _block(m: Column, container: Column, kind: str, k: Column, aliases: dict, suffix: Column) -> Column:
    def pick(role):
        names = aliases.get(role, [])
        vals = [F.try_element_at(m, F.concat(F.lit(a), suffix)) for a in names]
        if not vals:
            return F.lit(None).cast(ROLE_TYPES[role])
        return F.try_variant_get(F.coalesce(*vals) if len(vals) > 1 else vals[0], "$", ROLE_TYPES[role])
    return F.struct(container.cast("int").alias("container"), F.lit(kind).alias("kind"), k.cast("bigint").alias("k"),
                    *[pick(r).alias(r) for r in ROLES])


def _container_blocks(m: Column, container: Column) -> Column:
    main = F.transform(_main_block_keys(m), lambda k: _block(
        m, container, KIND_MAIN, k, catalog.MAIN_BLOCK_ALIASES,
        F.when(k == 0, F.lit("")).otherwise(k.cast("string"))))
    credit_keys = [a for names in catalog.CREDIT_BLOCK_ALIASES.values() for a in names]
    has_credit = F.exists(F.map_keys(m), lambda x: x.isin(credit_keys))
    credit = _block(m, container, KIND_CREDIT, F.lit(0), catalog.CREDIT_BLOCK_ALIASES, F.lit(""))
    return F.concat(main, F.when(has_credit, F.array(credit)).otherwise(_no_blocks()))


def _legacy_blocks(m: Column) -> Column:
    """``fieldsN`` / ``dataN`` / ``subtitleN`` of any number; blocks without fields or data are dropped."""
    blocks = F.transform(_suffix_numbers(m, r"^fields(\d+)$"), lambda i: _block(
        m, F.lit(0), KIND_LEGACY, i, {"title": ["subtitle"], "fields": ["fields"], "data": ["data"]}, i.cast("string")))
    length = lambda value: F.coalesce(F.size(value), F.lit(0))
    return F.filter(blocks, lambda b: (length(b["fields"]) > 0) & (length(b["data"]) > 0))


def _with_maps(docs: DataFrame, *extra: str) -> DataFrame:
    """The document as a map of top-level keys plus the maps of its ``tables``
    elements, materialised once per row (lambdas below only look them up)."""
    m = F.try_variant_get("doc", "$", "map<string,variant>")
    tabs = F.filter(F.transform(F.coalesce(F.try_variant_get("doc", "$.tables", "array<variant>"),
                                           F.array().cast("array<variant>")),
                                lambda t: F.try_variant_get(t, "$", "map<string,variant>")),
                    lambda t: t.isNotNull())
    return docs.select(*IDS, *extra, m.alias("_m"), tabs.alias("_tabs"))


def block_array(m: Column, tabs: Column) -> Column:
    """X1 + X2 for one document: array of blocks."""
    nested = F.flatten(F.transform(tabs, lambda t, i: _container_blocks(t, i + 1)))
    found = F.array(F.concat(_container_blocks(m, F.lit(0)), nested))  # one element: evaluated once
    return F.when(m.isNull(), _no_blocks()).otherwise(F.transform(
        found, lambda x1: F.when(F.size(x1) > 0, x1).otherwise(_legacy_blocks(m)))[0])


def extract_subtables(docs: DataFrame, keep_bare: bool = False) -> DataFrame:
    """X1 + X2: every sub-table block of every document.

    Main blocks use the bare names, then suffixes 1, 2, ...; blocks 0 and 1
    may be missing, from 2 on the numbering stops at the first gap.  Then the
    credit block; then the same inside every element of ``tables``.  The
    first alias present wins (title before subtitle).  Documents where this
    finds nothing fall back to the legacy scan of ``fieldsN``/``dataN``/
    ``subtitleN`` (blocks without fields or data are dropped).

    Output: item, source_file, date_key, container, kind, k, title, fields,
    data, groups, notes.  ``keep_bare`` adds one row of NULL ``kind`` for each
    document without any block, and the column ``is_object``.
    """
    extra = ["is_object"] if keep_bare else []
    explode = F.explode_outer if keep_bare else F.explode
    if "text_tables" in docs.columns:
        d = _with_maps(docs.withColumn("doc", F.when(F.col("text_tables").isNull(), F.col("doc"))), *extra, "text_tables")
        found = F.when(F.col("text_tables").isNotNull(), _text_blocks(F.col("text_tables"))).otherwise(
            block_array(F.col("_m"), F.col("_tabs")))
    elif "plain" in docs.columns:
        d = _with_maps(docs.withColumn("doc", F.when(F.col("plain").isNull(), F.col("doc"))), *extra, "plain")
        found = F.when(F.col("plain").isNotNull(), F.array(_plain_block(F.col("plain")))).otherwise(
            block_array(F.col("_m"), F.col("_tabs")))
    else:
        d, found = _with_maps(docs, *extra), block_array(F.col("_m"), F.col("_tabs"))
    return d.select(*IDS, *extra, explode(found).alias("b")).select(*IDS, *extra, "b.*")


def _plain_block(table: Column) -> Column:
    """The main block of a plain document (``sources.documents``), whose table is its only one."""
    of = {"container": F.lit(0), "kind": F.lit(KIND_MAIN), "k": F.lit(0).cast("bigint")}
    roles = {r: table[r] if r in ("title", "fields", "data") else F.lit(None).cast(ROLE_TYPES[r]) for r in ROLES}
    return F.struct(*[c.alias(n) for n, c in {**of, **roles}.items()])


def _text_blocks(tables: Column) -> Column:
    """The main blocks of a document of text tables (``sources.documents``), in which a member is null only where it is missing."""
    def block(container: Column, k: int, of: dict[str, Column]) -> Column:
        first = {"container": container.cast("int"), "kind": F.lit(KIND_MAIN), "k": F.lit(k).cast("bigint")}
        roles = {r: of.get(r, F.lit(None).cast(ROLE_TYPES[r])) for r in ROLES}
        return F.struct(*[c.alias(n) for n, c in {**first, **roles}.items()])
    numbered = [block(F.lit(0), k, {
        "title": F.coalesce(tables[f"title{n}"], tables[f"subtitle{n}"]), "fields": tables[f"fields{n}"], "data": tables[f"data{n}"]})
        for k, n in enumerate(TABLE_SUFFIXES)]
    # without a block 2 the numbering has stopped: most documents need no look at the others
    more = functools.reduce(lambda a, b: a | b, [tables[f"{role}2"].isNotNull() for role in ("title", "subtitle", "fields", "data")])
    numbered = F.when(more, F.array(*numbered)).otherwise(F.array(*numbered[:2]))
    there = F.filter(numbered, lambda b: b["title"].isNotNull() | b["fields"].isNotNull() | b["data"].isNotNull())
    main = F.concat(F.filter(there, lambda b: b["k"] < 2), F.filter(F.filter(there, lambda b: b["k"] >= 2), lambda b, i: b["k"] == i + 2))
    nested = F.transform(tables["tables"], lambda t, i: block(i + 1, 0, {r: t[r] for r in ("title", "fields", "data")}))
    return F.concat(main, F.coalesce(nested, _no_blocks()))


def _non_empty() -> Column:
    return (F.coalesce(F.size("fields"), F.lit(0)) > 0) & (F.coalesce(F.size("data"), F.lit(0)) > 0)


def skip_empty(blocks: DataFrame) -> DataFrame:
    """Blocks without fields or without data are skipped."""
    return blocks.where(_non_empty())


def no_table_error() -> Column:
    """Q4: why a document yields no sub-table at all (rows of NULL ``kind``)."""
    return F.when(F.col("is_object"), F.lit("no sub-table found")).otherwise(F.lit("document is not an object"))


# X6 / X7 ------------------------------------------------------------------
# Key classes and the texts that name them.
KEY_CLASSES = {"col": ("field",), "value": ("data", "list"), "title": ("title",)}


def _keys_of_class(keys: Column, marks: Sequence[str]) -> Column:
    return F.sort_array(F.filter(keys, lambda k: functools.reduce(
        lambda a, b: a | b, [F.lower(k).contains(x) for x in marks])))


def classify_keys(docs: DataFrame) -> DataFrame:
    """Top-level keys classed by substring: 'field' -> col, 'data' or
    'list' -> value, 'title' -> title; a key may be of several classes."""
    keys_of = docs.where("is_object").select(*IDS, F.map_keys(F.try_variant_get("doc", "$", "map<string,variant>")).alias("_keys"))

    def named(keys: Column, name: str) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(name).alias("key_class")))
    by_class = F.flatten(F.array(*[named(_keys_of_class(F.col("_keys"), marks), name) for name, marks in KEY_CLASSES.items()]))
    return keys_of.select(*IDS, F.explode(by_class).alias("k")).select(*IDS, "k.key", "k.key_class")


def tables_by_key_class(docs: DataFrame) -> DataFrame:
    """X6 productdict: pair the n-th col / value / title keys (sorted) of each
    document into (title, fields, data), within the row; empty values are skipped."""
    m = F.col("m")
    d = docs.where("is_object").select(*IDS, F.try_variant_get("doc", "$", "map<string,variant>").alias("m"))
    keys = F.arrays_zip(*[_keys_of_class(F.map_keys(m), marks).alias(name) for name, marks in KEY_CLASSES.items()])
    j = d.select(*IDS, "m", F.posexplode(keys).alias("at", "key"))
    out = j.select(
        *IDS, (F.col("at") + 1).alias("n"),
        F.try_variant_get(F.try_element_at(m, F.col("key.title")), "$", "string").alias("title"),
        F.try_variant_get(F.try_element_at(m, F.col("key.col")), "$", "array<string>").alias("fields"),
        F.try_variant_get(F.try_element_at(m, F.col("key.value")), "$", "array<array<string>>").alias("data"))
    return out.where(_non_empty())


# X8 / N15 -----------------------------------------------------------------
_SUB_ARRAY = "array<struct<sub:string,norm:string>>"


def subtitle_config(catalogue: DataFrame) -> dict[str, list[str]]:
    """item -> configured subtitles (configuration rows, bounded)."""
    return {r["item"]: list(r["subtitle"] or []) for r in catalogue.select("item", "subtitle").collect()}


def attach_normalized_titles(df: DataFrame, title_col: str = "title") -> DataFrame:
    """Adds ``title_norm``; only titles that NFKC may change go through the Arrow function."""
    return df.withColumn("title_norm", S.nfkc_strip_fast(F.col(title_col)))


def match_titles(df: DataFrame, config: dict[str, Sequence[str]], item_col: str = "item",
                 title_col: str = "title", rename: dict | None = None) -> DataFrame:
    """X8 per row: the one configured subtitle contained in the NFKC-normalised,
    stripped title, under the name that ``rename`` gives it.

    The configuration is normalised once on the driver and inlined as a
    literal map; only the title column goes through the NFKC pandas UDF
    (Arrow batches).  No join, no shuffle.  Adds ``title_norm``, ``n_hits``,
    ``subitem`` (NULL on error) and ``match_error``.
    """
    rename = rename or {}
    entries = []
    for item, subs in config.items():
        arr = F.array(*[F.struct(F.lit(rename.get(x, x)).alias("sub"),
                                 F.lit(unicodedata.normalize("NFKC", x).strip()).alias("norm")) for x in subs]) \
            if subs else F.array().cast(_SUB_ARRAY)
        entries += [F.lit(item), arr.cast(_SUB_ARRAY)]
    subs = F.try_element_at(F.create_map(*entries), F.col(item_col)) if entries else F.lit(None).cast(_SUB_ARRAY)
    out = attach_normalized_titles(df, title_col)
    hits = F.filter(F.coalesce(subs, F.array().cast(_SUB_ARRAY)),
                    lambda x: (x["norm"] != "") & F.col("title_norm").contains(x["norm"]))
    n_conf = F.size(F.filter(F.coalesce(subs, F.array().cast(_SUB_ARRAY)), lambda x: x["norm"] != ""))
    out = out.withColumn("_hits", hits).withColumn("n_hits", F.size("_hits"))
    err = (F.when(F.col(title_col).isNull(), F.lit("title is null"))
            .when(F.col("title_norm") == "", F.lit("title is blank"))
            .when(n_conf == 0, F.lit("no subtitles configured for item"))
            .when(F.col("n_hits") == 0, F.lit("no configured subtitle in title"))
            .when(F.col("n_hits") > 1, F.lit("several configured subtitles in title")))
    return (out.withColumn("match_error", err)
               .withColumn("subitem", F.when(F.col("match_error").isNull(), F.col("_hits")[0]["sub"]))
               .drop("_hits"))


# P1 / P2 / P6 / X4 (header lists: plan-time metadata) ----------------------
def normalize_names(cols: Sequence[str], rename: dict | None = None) -> list[str]:
    """Dictionary rename, then remove '</br>' tags."""
    rename = rename or {}
    return [str(rename.get(c, c)).replace("</br>", "") for c in cols]


def occurrences(names: Sequence[str]) -> list[int]:
    """How often each position's name has stood up to there, itself included."""
    return [list(names[:i + 1]).count(n) for i, n in enumerate(names)]


def repair_duplicate_names(cols: Sequence[str], prefixes: Sequence[str] = ()) -> list[str]:
    """Unique names for a header that repeats names.

    The repeated part runs from the first place of the most repeated name
    (leftmost of equals) to the end.  If it splits into as many equal segments
    as there are group prefixes (two or more), each name takes its segment's
    prefix; otherwise, or if that leaves repeats, the n-th place of a name gets '__n'.
    """
    names, groups = [str(c) for c in cols], [p.strip() for p in prefixes if p and p.strip()]
    rank = occurrences(names)
    if max(rank, default=1) == 1:
        return names
    begin = names.index(statistics.mode(names))
    candidates = []
    if len(groups) > 1 and (len(names) - begin) % len(groups) == 0:
        length = (len(names) - begin) // len(groups)
        candidates.append(names[:begin] + [f"{groups[at // length]}_{n}" for at, n in enumerate(names[begin:])])
    candidates.append([n if r == 1 else f"{n}__{r}" for n, r in zip(names, rank)])
    for header in candidates:
        if max(occurrences(header)) == 1:
            return header
    raise DataCleanError("duplicate column names cannot be repaired", value=names)


def grouped_header(cols: Sequence[str], spans: Sequence[tuple], prefixed: Sequence[str] | None = None) -> list[str]:
    """Columns of span (prefix, start, end) get 'prefix_' in front.

    Only groups named in ``prefixed`` are prefixed (default: all but the
    first and the last group, which hold the key and the trailing notes).
    The header is padded with NULL names / cut to the spans' total length.
    """
    if prefixed is None:
        prefixed = [s[0] for s in spans[1:-1]]
    total = max(e for _, _, e in spans)
    out = list(cols[:total]) + [None] * max(0, total - len(cols))
    for prefix, start, end in spans:
        if prefix in prefixed:
            for i in range(start, end):
                if out[i] is not None:
                    out[i] = f"{prefix}_{out[i]}"
    return out


@dataclass
class TableSpec:
    """Declared handling of one sub-table (plan-time configuration)."""

    item: str
    subitem: str
    rename: dict = field(default_factory=dict)          # P2
    int_cols: list = field(default_factory=list)        # N3, integer target
    float_cols: list = field(default_factory=list)      # N3, float target
    date_cols: list = field(default_factory=lambda: ["date"])  # N6
    pk: list | None = None                              # W7 (None -> inferred)
    spans: list | None = None                           # X4
    sign: tuple | None = None                           # N5 (value col, sign col)
    drop: list = field(default_factory=lambda: list(catalog.DROP_COLUMNS))  # P3


def final_header(fields: Sequence[str], spec: TableSpec | None, global_rename: dict | None = None) -> list[str]:
    """Header of one variant after X4 spans, P1 normalisation and P6 repair;
    positions without a header name become '_padN' (dropped later)."""
    cols = list(fields)
    if spec is not None and spec.spans:
        cols = grouped_header(cols, spec.spans)
    cols = [f"_pad{i}" if c is None else c for i, c in enumerate(cols)]
    cols = normalize_names(cols, global_rename)
    prefixes = [s[0] for s in spec.spans] if spec is not None and spec.spans else []
    return repair_duplicate_names(cols, prefixes)


def default_spec(item: str, subitem: str) -> TableSpec:
    """The shipped configuration of a sub-table: numbers, header rename, grouped header."""
    return TableSpec(item=item, subitem=subitem, rename=catalog.DATASET_RENAME.get((item, subitem), {}),
                     float_cols=list(catalog.NUMERIC_COLUMNS.get((item, subitem), ())),
                     spans=catalog.FIELD_SPANS.get(subitem))


def header_of(fields: Column, item: Column, subitem: Column, specs: Sequence[TableSpec], rename: dict) -> Column:
    """The final names of a block's header.  Only the column spans depend on the table; they are
    configuration (given specs, else the shipped spans of the sub-table)."""
    spans = {(None, sub): s for sub, s in catalog.FIELD_SPANS.items()} | {(x.item, x.subitem): x.spans for x in specs}
    out = headers.final_names(fields, None, rename)
    for (of_item, of_sub), s in spans.items():  # given specs come last and count first
        if not s and of_sub not in catalog.FIELD_SPANS:
            continue
        mine = subitem == of_sub if of_item is None else (item == of_item) & (subitem == of_sub)
        out = F.when(mine, headers.final_names(fields, s, rename)).otherwise(out)
    return out


# X3 + finalize -------------------------------------------------------------
def frame_up(blocks: DataFrame, spec: TableSpec, names: Sequence[str], rename: dict,
             usual: tuple[Sequence, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """X3/X4 + P1-P6 + N3-N6: one typed frame of the blocks of (``spec.item``, ``spec.subitem``).

    ``names`` are the table's final column names; the cells of a block are picked by the places of
    the final names of its own header: short rows give NULL, surplus cells are dropped (X7).
    ``usual`` holds the fields and the final names of one header, whose places stand in the plan; those of
    any other header are found in the block's row, and blocks whose header cannot be repaired are left out.
    Returns (table, errors).  The table carries ``source_file``, ``block_k`` and ``row_pos`` (arrival
    order for keep-last).
    """
    if not names:
        raise DataCleanError("no header seen for sub-table", item=spec.item, subitem=spec.subitem)
    text = lambda values: F.array(*[F.lit(v).cast("string") for v in values])
    place = {c: i for i, c in enumerate(usual[1])}

    def places(final: Column) -> Column:  # one map a block from names to places, so that a row looks a name up once
        return F.when(F.size(final) > 0, let(F.map_from_arrays(final, F.sequence(F.lit(0), F.size(final) - 1)),
                                             lambda m: F.array(*[F.try_element_at(m, F.lit(c)) for c in names])))
    at = F.when(F.col("fields") == text(usual[0]), F.array(*[F.lit(place.get(c)).cast("int") for c in names])).otherwise(
        let(headers.final_names(F.col("fields"), spec.spans, rename), places))
    doc_date = parse_any_date(F.col("date_key")).alias("_doc_date")
    rows = (blocks.where((F.col("item") == spec.item) & (F.col("subitem") == spec.subitem))
            .select(*IDS, doc_date, "subitem", F.col("k").alias("block_k"), "container", at.alias("at"), "data")
            .where(F.col("at").isNotNull())
            .select(*IDS, "_doc_date", "subitem", "block_k", "container", "at", F.posexplode("data").alias("row_pos", "row")))
    cells = [F.get("row", F.get("at", F.lit(i))).alias(c) for i, c in enumerate(names)]
    df = rows.select(*IDS, "subitem", "container", "block_k", "row_pos", "_doc_date", *cells)
    return finalize(df, spec)


def finalize(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """P3 drop, P2 rename, N5 sign, N3 numbers, P4 date, N6 dates, P5 order."""
    meta = [*IDS, "subitem", "container", "block_k", "row_pos"]
    df = df.drop(*[c for c in spec.drop if c in df.columns and (not spec.sign or c != spec.sign[1])])
    if spec.rename:
        df = df.withColumnsRenamed({k: v for k, v in spec.rename.items() if k in df.columns})
    if spec.sign and spec.sign[0] in df.columns and spec.sign[1] in df.columns:
        df = df.withColumn(spec.sign[0], S.apply_sign(S.parse_number(spec.sign[0]), spec.sign[1])).drop(spec.sign[1])
    casts = {c: S.parse_number(c, "bigint") for c in spec.int_cols if c in df.columns}
    casts.update({c: S.parse_number(c, "double") for c in spec.float_cols if c in df.columns})
    if casts:
        df = df.withColumns(casts)
    of_document = "date" not in df.columns
    if of_document:
        df = df.withColumn("date", F.col("date_key"))
    parsed = {c: parse_any_date(F.col(c)) for c in spec.date_cols if c in df.columns}
    if of_document and "date" in parsed and "_doc_date" in df.columns:
        parsed["date"] = F.col("_doc_date")
    df = df.withColumns({f"_raw_{c}": F.col(c) for c in parsed}).withColumns(parsed).drop("_doc_date")
    # a bad row is told by plain columns: where they are the document's, the filters go below the explode of its rows
    bad = {c: F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull() for c in parsed}
    is_bad = functools.reduce(lambda a, b: a | b, bad.values(), F.lit(False))
    errs = [F.when(failed, error_struct("date parse failed", file=F.col("source_file"), item=F.col("item"),
                                        subitem=F.col("subitem"), column=c, value=F.col(f"_raw_{c}"),
                                        value_type=F.typeof(F.col(f"_raw_{c}")), date=F.col("date_key"),
                                        hint="add a date rule for this column"))
            for c, failed in bad.items()]
    error = F.coalesce(*errs) if errs else F.lit(None)
    errors = df.where(is_bad).select(*IDS, error.alias("error"))
    good = df.where(~is_bad).drop(*[f"_raw_{c}" for c in parsed])
    front = [c for c in ("date", "代號", "名稱") if c in good.columns]
    rest = [c for c in good.columns if c not in front and c not in meta]
    return good.select(*front, *rest, *meta), errors


def parse_any_date(c: Column) -> Column:
    """Compact ('yyyyMMdd'), Minguo ('yyy/mm/dd'), ISO ('yyyy-M-d') or
    slashed ('yyyy/M/d') text -> DATE; NULL when none fits.  The usual spellings of a
    form are cast; what is left, dates that do not exist among it, goes to the formatters."""
    def cut(t: Column) -> Column:  # the plain forms as 'y-m-d' text
        year, dashed = F.substring_index(t, "/", 1), lambda x: F.replace(x, F.lit("/"), F.lit("-"))
        return (F.when(t.rlike(r"\A[0-9]{2,3}/[0-9]{1,2}/[0-9]{1,2}\z"), F.concat(
                    (year.try_cast("int") + F.lit(1911)).cast("string"), dashed(F.substr(t, F.length(year) + 1))))
                .when(t.rlike(r"\A(?!0000)[0-9]{8}\z"), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))
                .when(t.rlike(r"\A(?!0000)[0-9]{4}([-/])[0-9]{1,2}[-/][0-9]{1,2}\z"), dashed(t)))
    text = F.trim(c.cast("string"))
    return F.coalesce(cut(text).try_cast("date"), let(text, _formatted_date))


def _formatted_date(t: Column) -> Column:
    parts = F.split(t, "/")
    minguo = F.concat_ws("-", (F.get(parts, 0).try_cast("int") + F.lit(1911)).cast("string"),
                         F.get(parts, 1), F.get(parts, 2))
    return F.coalesce(
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
        F.when(t.rlike(r"^\d{2,3}/\d{1,2}/\d{1,2}$"), F.try_to_date(minguo, "yyyy-M-d")),
        F.try_to_date(F.regexp_replace(t, "/", "-"), "yyyy-M-d"))
