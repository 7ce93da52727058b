"""Headers of sub-tables as column expressions (X3, X4, P1, P6) and their registry.

The final names of a block's columns are computed in the block's own row, so a plan is the
same for ten header variants and for ten thousand, no join moves document content by its
header, and a header that cannot be repaired costs its own blocks only.  One header usually
holds nearly all documents of a table: it stands in the plan with its final names, which are
computed for the others only.  The distinct variants form the registry table; the driver reads
from it the final column names, the most frequent variant of each table and which tables have a
header that cannot be repaired, nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.date_labels import let

BAD_HEADER = "duplicate column names cannot be repaired"


def normalized(names: Column, rename: dict[str, str]) -> Column:
    """Dictionary rename, then remove '</br>' tags."""
    # few names are renamed: a set tells them, so that the map is not walked through for every name
    table = F.create_map(*[F.lit(x) for pair in rename.items() for x in pair]) if rename else None
    renamed = (lambda c: F.when(c.isin(list(rename)), F.try_element_at(table, c)).otherwise(c)) if rename else (lambda c: c)
    return F.transform(names, lambda c: F.replace(renamed(c), F.lit("</br>"), F.lit("")))


def spanned(fields: Column, spans: Sequence[tuple]) -> Column:
    """Columns of the inner groups get 'group_' in front; the header is padded or cut to the groups' length."""
    total = max(end for _, _, end in spans)

    def name(i: Column) -> Column:
        group = F.lit(None).cast("string")
        for prefix, start, end in spans[1:-1]:
            group = F.when((i >= start) & (i < end), F.lit(prefix)).otherwise(group)
        field = F.get(fields, i)
        return F.when(group.isNotNull() & field.isNotNull(), F.concat(group, F.lit("_"), field)).otherwise(field)
    return F.transform(F.sequence(F.lit(0), F.lit(total - 1)), name)


def _equal_to(names: Column, name: Column) -> Column:
    return F.size(F.filter(names, lambda other: other == name))


def repaired(names: Column, groups: Sequence[str]) -> Column:
    """Unique names.  The repeated part runs from the first place of the most repeated name to the
    end; if it splits into as many equal segments as there are groups (two or more), names take their segment's
    group, else, or if that leaves repeats, the n-th place of a name takes '__n'.  NULL if repeats stay."""
    groups = [g.strip() for g in groups if g and g.strip()]

    def unique(candidate: Column) -> Column:
        return F.when(F.size(F.array_distinct(candidate)) == F.size(candidate), candidate)

    def repair(ranked: Column) -> Column:  # of (name, how often it has stood up to there)
        plain = ranked["name"]
        numbered = F.transform(ranked, lambda c: F.when(c["rank"] == 1, c["name"]).otherwise(
            F.concat(c["name"], F.lit("__"), c["rank"].cast("string"))))
        if len(groups) < 2:
            return let(numbered, unique)

        def segmented(begin: Column) -> Column:  # from 0
            length = (F.size(ranked) - begin) / len(groups)
            return F.when((F.size(ranked) - begin) % len(groups) == 0, F.transform(plain, lambda c, i: F.when(i < begin, c).otherwise(
                F.concat(F.get(F.array(*map(F.lit, groups)), F.floor((i - begin) / length).cast("int")), F.lit("_"), c))))
        totals = F.transform(plain, lambda c: _equal_to(plain, c))
        first = let(totals, lambda t: F.array_position(t, F.array_max(t)).cast("int") - 1)
        return F.coalesce(let(let(first, segmented), unique), let(numbered, unique))

    ranked = F.transform(names, lambda c, i: F.struct(c.alias("name"), _equal_to(F.slice(names, F.lit(1), i + 1), c).alias("rank")))
    # most headers repeat nothing: they are told by their distinct names, without a rank for every place
    return F.coalesce(unique(names), let(ranked, repair))


def final_names(fields: Column, spans: Sequence[tuple] | None, rename: dict[str, str]) -> Column:
    """The names of a header after X4, P1 and P6; places without a name become '_padN' (dropped later)."""
    cols = spanned(fields, spans) if spans else fields
    filled = F.transform(cols, lambda c, i: F.coalesce(c, F.concat(F.lit("_pad"), i.cast("string"))))
    return let(normalized(filled, rename), lambda names: repaired(names, [s[0] for s in spans] if spans else []))


def registry_of(blocks: DataFrame, final: Callable[[Column], Column]) -> DataFrame:
    """One row per header variant: its id, table, fields, final names (null if they cannot be repaired) and number of blocks."""
    variants = blocks.groupBy("item", "subitem", "fields").agg(F.count("*").alias("n_blocks"))
    return variants.select("item", "subitem", F.format_string("%016x", F.xxhash64("fields")).alias("variant"), "fields",
                           final(F.col("fields")).alias("final"), "n_blocks")


def usual_headers(registry: DataFrame) -> dict[tuple[str, str], tuple[list, list[str]]]:
    """(item, sub-table) -> fields and final names of the variant that most of its blocks have."""
    rows = registry.groupBy("item", "subitem").agg(F.max(F.struct("n_blocks", "fields", "final")).alias("most")).collect()
    return {(r["item"], r["subitem"]): (list(r["most"]["fields"]), list(r["most"]["final"])) for r in rows}


def tables_with_bad_headers(seen: DataFrame) -> set[tuple[str, str]]:
    """The tables of which a variant could not be repaired."""
    return {(r["item"], r["subitem"]) for r in seen.where(F.col("final").isNull()).select("item", "subitem").distinct().collect()}


def column_names(registry: DataFrame) -> dict[tuple[str, str], list[str]]:
    """(item, sub-table) -> final column names, in the order of the least header that has them."""
    places = registry.select("item", "subitem", "fields", F.posexplode("final").alias("at", "name"))
    rows = (places.where(~F.col("name").startswith("_pad"))
            .groupBy("item", "subitem", "name").agg(F.min(F.struct("fields", "at")).alias("first"))
            .withColumn("order", F.row_number().over(Window.partitionBy("item", "subitem").orderBy("first", "name")))
            .select("item", "subitem", "order", "name").collect())
    out: dict[tuple[str, str], list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["item"], r["subitem"], r["order"])):
        out.setdefault((r["item"], r["subitem"]), []).append(r["name"])
    return out
