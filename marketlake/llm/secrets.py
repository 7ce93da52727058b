"""Secret scans with a randomness test battery (DataFrame functions only).

Base patterns (assignments, access keys, long hex) are found by regular
expressions.  Beyond them, every run of 20 or more symbols of base64 and every
such run of base64url is tested (where both alphabets meet, as in paths and
urls, neither loses its run to the other's separators; a run of both counts
once): its encoding is inferred from the symbols it uses, then

* chi-squared uniformity over that alphabet.  Its lower tail under ordinary
  text - noncentral chi-squared, the noncentrality n * (k * coincidence - 1) of
  text with the usual rate of coincident letters - is the p-value for "this is
  ordinary text"; it shrinks with length;
* a runs test about the alphabet's middle and a lag-1 serial correlation, which
  refuse counters, repeats and keyboard sequences.

Benjamini-Hochberg runs within classes of equal length (powers of two), so that
the many short runs do not pay for the few long ones.  Over all texts, p-values
are counted on a fixed grid (1/50 decade, rounded up), so the threshold table is
bounded whatever the corpus; it is the only thing joined back (one row).

Offsets are code points, ends exclusive; everything is computed within the row.

Defined results: null text = empty text: no spans; nested or overlapping finds of
different kinds are all listed, except that a random run overlapping a base find is
not added, nor one within a longer random run that is listed; repeated rows are scanned alike; ties (equal starts) are listed in
the order of kinds; empty table: no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import col, stored, whole_row

# fixed values of the contract
KINDS = ("assign", "access", "hex", "random")
ASSIGN_HEAD = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
ASSIGN = ASSIGN_HEAD + r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

MIN_RUN = 20
RUNS = tuple(rf"(?<![{c}])[{c}]{{{MIN_RUN},}}" for c in ("A-Za-z0-9+/", r"A-Za-z0-9_\-"))

# inferred encodings, narrowest first: pattern, alphabet, rate at which two symbols of ordinary text coincide
LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", "[0-9a-f]+", DIGITS + "abcdef", 0.26),
    ("hex_upper", "[0-9A-F]+", DIGITS + "ABCDEF", 0.26),
    ("base32", "[A-Z2-7]+", LOWER.upper() + "234567", 0.065),
    ("base36", "[a-z0-9]+", DIGITS + LOWER, 0.065),
    ("base62", "[A-Za-z0-9]+", DIGITS + LOWER.upper() + LOWER, 0.065),
    ("base64", "[A-Za-z0-9+/]+", LOWER.upper() + LOWER + DIGITS + "+/", 0.065),
    ("base64url", "[A-Za-z0-9_-]+", LOWER.upper() + LOWER + DIGITS + "-_", 0.065),
)
#: false-discovery rate, and the level at which a test refuses randomness (two-sided z)
FDR = 0.01
REFUSE_Z = 3.29
GRID = 50
MAX_BIN = 1000
MARK = "[SECRET]"
#: items of an array that are folded together
BLOCK = 128


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _blocks(items: Column) -> Column:
    """An array in stretches of BLOCK items."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.slice(items, i, BLOCK))


def _before(items: Column, zero: Column, join) -> Column:
    """For each item the join of all before it (``zero`` before the first); ``join`` is associative.

    Within blocks first, then over the blocks: an array that grows by one item is copied BLOCK times at most
    per item, instead of once for every item of the text.
    """
    empty = F.slice(F.array(zero), 1, 0)

    def fold(values: Column, value) -> Column:
        return F.aggregate(values, F.struct(zero.alias("at"), empty.alias("out")), lambda s, x: F.struct(
            join(s["at"], value(x)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))

    def over(folded: Column) -> Column:
        outer = fold(folded, lambda f: f["at"])["out"]
        return F.flatten(F.zip_with(folded, outer, lambda f, o: F.transform(f["out"], lambda v: join(o, v))))
    return _let(F.transform(_blocks(items), lambda block: fold(block, lambda x: x)), over)


def _spans(text: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """array<struct<start,end,token>> of all matches; ``least``: code points of the group, else dropped."""
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group or 0)).alias("value"))
    # the last gap has no hit after it
    sizes = F.transform(F.filter(found, lambda x: x["hit"].isNotNull()), lambda x: F.struct(
        F.length(x["gap"]).cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("long"), x["hit"].alias("hit"),
        (F.length(x["value"]) >= least).alias("kept")))

    def placed(hits: Column) -> Column:
        before = _before(F.transform(hits, lambda h: h["gap"] + h["long"]), F.lit(0).cast("long"), lambda a, b: a + b)
        return F.zip_with(hits, before, lambda h, at: F.struct(
            (at + h["gap"]).alias("start"), (at + h["gap"] + h["long"]).alias("end"), h["hit"].alias("token"), h["kept"].alias("kept")))

    kept = F.filter(_let(sizes, placed), lambda x: x["kept"])
    return F.transform(kept, lambda x: F.struct(x["start"], x["end"], x["token"]))


def _lower_tail(z: Column) -> Column:
    """Standard normal P(Z <= z) for z <= 0 (Abramowitz and Stegun 26.2.17); 1 above."""
    def of(z: Column) -> Column:
        t = 1 / (1 - 0.2316419 * z)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.when(z <= 0, F.exp(-z * z / 2) * 0.3989422804014327 * poly).otherwise(1.0)
    return _let(z, of)


def _order_z(token: Column, alphabet: Column, k: Column, n: Column) -> Column:
    """The larger of the runs test's and the serial correlation's |z|."""
    def sums(at: Column) -> Column:
        pairs = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1),
                           lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        mid = (k + 1) / 2
        return F.struct(
            F.aggregate(at, F.lit(0.0), lambda s, x: s + F.when(x > mid, 1.0).otherwise(0.0)).alias("above"),
            F.aggregate(pairs, F.lit(1.0), lambda s, p: s + F.when((p["x"] > mid) != (p["y"] > mid), 1.0).otherwise(0.0))
            .alias("runs"),
            (F.aggregate(at, F.lit(0.0), lambda s, x: s + x) / n).alias("mean"),
            F.aggregate(at, F.lit(0.0), lambda s, x: s + x * x).alias("power"),
            F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["x"] * p["y"]).alias("lag"),
            at[0].alias("first"), F.element_at(at, -1).alias("last"))

    def worst(s: Column) -> Column:
        a, b = s["above"], n - s["above"]
        expected = 2 * a * b / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(spread > 0, F.abs(s["runs"] - expected) / F.sqrt(spread)).otherwise(99.0)
        variance = s["power"] - n * s["mean"] * s["mean"]
        # sum of (x - m)(y - m) over neighbours
        joint = s["lag"] - s["mean"] * (2 * n * s["mean"] - s["first"] - s["last"]) + (n - 1) * s["mean"] * s["mean"]
        serial = F.when(variance > 0, F.abs(joint / variance + 1 / n) * F.sqrt(n)).otherwise(99.0)
        return F.greatest(runs, serial)

    at = F.filter(F.transform(F.split(token, "", -1), lambda c: F.instr(alphabet, c).cast("double")), lambda x: x > 0)
    return _let(_let(at, sums), worst)


def _battery(token: Column) -> Column:
    """p-value of a run for "ordinary text"; 1 if no encoding fits or a test refuses randomness."""
    encoding = F.lit(None).cast("struct<alphabet:string,coincidence:double>")
    for _, pattern, alphabet, coincidence in reversed(ENCODINGS):
        encoding = F.when(token.rlike(f"^{pattern}$"), F.struct(
            F.lit(alphabet).alias("alphabet"), F.lit(coincidence).alias("coincidence"))).otherwise(encoding)

    def counted(e: Column) -> Column:
        square = lambda c: F.pow((F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0))
        return F.struct(e["alphabet"].alias("alphabet"), e["coincidence"].alias("coincidence"),
                        F.length(e["alphabet"]).cast("double").alias("k"), F.length(token).cast("double").alias("n"),
                        F.aggregate(F.filter(F.split(e["alphabet"], "", -1), lambda c: c != ""), F.lit(0.0),
                                    lambda s, c: s + square(c)).alias("squares"))

    def p_value(c: Column) -> Column:
        k, n = c["k"], c["n"]
        chi = k * c["squares"] / n - n
        excess = k * c["coincidence"] - 1
        ordinary = (chi - (k - 1) - excess * n) / F.sqrt(2.0 * (k - 1) + 4 * excess * n)
        uniform = (chi - (k - 1)) / F.sqrt(2.0 * (k - 1))
        return F.when((F.abs(uniform) > REFUSE_Z) | (_order_z(token, c["alphabet"], k, n) > REFUSE_Z), 1.0) \
            .otherwise(_lower_tail(ordinary))

    # digits alone are numbers, not keys
    return F.when(token.rlike("^[0-9]+$"), 1.0).otherwise(F.coalesce(_let(_let(encoding, counted), p_value), F.lit(1.0)))


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _tested(span: Column) -> Column:
    """A run with its length class and p-value bin; bin 0 = no evidence."""
    grid = lambda p: F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * GRID), F.lit(MAX_BIN)).cast("int")
    return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                    F.floor(F.log2(F.length(span["token"]))).cast("int").alias("size"),
                    F.greatest(_let(_battery(span["token"]), grid), F.lit(0)).alias("bin"))


def _thresholds(runs: DataFrame) -> DataFrame:
    """One row: a map from length class to the least bin that is a discovery (Benjamini-Hochberg on the grid)."""
    counts = runs.groupBy("size", "bin").agg(F.count("*").alias("n"))
    at_least = Window.partitionBy("size").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    passed = (counts.withColumn("found", F.sum("n").over(at_least))
              .withColumn("all", F.sum("n").over(Window.partitionBy("size")))
              .where(F.col("all") * F.pow(F.lit(10.0), -F.col("bin") / GRID) <= FDR * F.col("found")))
    least = passed.groupBy("size").agg(F.min("bin").alias("bin"))
    return least.agg(F.map_from_entries(F.collect_list(F.struct("size", "bin"))).alias("threshold"))


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span."""
    far = F.lit((1 << 62) - 1)
    event = lambda x, kind: F.struct(x["start"].cast("long").alias("start"), F.lit(kind).alias("kind"), x["end"].cast("long").alias("end"))
    # by start, base spans first: a run meets an earlier span that ends after its start, or a later one that starts before its end
    events = F.array_sort(F.concat(F.transform(base, lambda b: event(b, 0)), F.transform(runs, lambda r: event(r, 1))))

    def judged(e: Column) -> Column:
        reach = _before(F.transform(e, lambda x: F.when(x["kind"] == 0, x["end"]).otherwise(F.lit(-1).cast("long"))), F.lit(-1).cast("long"), F.greatest)
        ahead = F.reverse(_before(F.reverse(F.transform(e, lambda x: F.when(x["kind"] == 0, x["start"]).otherwise(far))), far, F.least))
        told = F.zip_with(e, F.arrays_zip(reach.alias("reach"), ahead.alias("ahead")), lambda x, o: F.struct(
            x.alias("x"), (o["reach"] > x["start"]).alias("earlier"), (o["ahead"] < x["end"]).alias("later")))
        free = F.filter(told, lambda t: (t["x"]["kind"] == 1) & ~t["earlier"] & ~t["later"])
        return F.transform(free, lambda t: F.struct(t["x"]["start"].alias("start"), t["x"]["end"].alias("end")))

    return F.when(F.size(runs) == 0, runs).when(F.size(base) == 0, runs).otherwise(_let(events, judged))


def _longest(runs: Column) -> Column:
    """The runs (all different) that lie in no other."""
    by_start = F.array_sort(F.transform(runs, lambda r: F.struct(r["start"].alias("start"), (-r["end"]).alias("back"))))

    def outer(e: Column) -> Column:
        reach = _before(F.transform(e, lambda x: -x["back"]), F.lit(-1).cast("long"), F.greatest)
        told = F.zip_with(e, reach, lambda x, r: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), (r >= -x["back"]).alias("inside")))
        return F.transform(F.filter(told, lambda t: ~t["inside"]), lambda t: F.struct(t["start"], t["end"]))

    return F.when(F.size(runs) < 2, runs).otherwise(_let(by_start, outer))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_row: bool = False) -> DataFrame:
    """One row per document: doc_id, base and spans (array<struct<start,kind,end>>, sorted), n_assign, n_access, n_hex.

    ``kind`` is the position in KINDS.  With ``keep_row`` the input row is kept as ``row``.
    """
    t = F.coalesce(col(text), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")
    d = docs.select(*([whole_row(docs).alias("row")] if keep_row else []), col(doc_id).alias("doc_id"), t.alias("t"))
    d = d.withColumns({
        "assign": F.when(F.col("t").rlike(ASSIGN_HEAD), _spans(F.col("t"), ASSIGN, 2, ASSIGN_VALUE)).otherwise(none),
        "access": F.when(F.col("t").contains("AKIA"), _spans(F.col("t"), ACCESS)).otherwise(none),
        "hex": F.when(F.col("t").rlike(HEX), _spans(F.col("t"), HEX)).otherwise(none),
        "run": _let(F.array_sort(F.concat(*[F.when(F.col("t").rlike(run), _spans(F.col("t"), run)).otherwise(none) for run in RUNS])),
                    lambda runs: F.filter(runs, lambda r, i: (i == 0) | (F.get(runs, i - 1) != r)))})
    bare = [_of_kind(F.col(k), i) for i, k in enumerate(KINDS[:3])]
    d = d.select(*(["row"] if keep_row else []), "doc_id",
                 *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                 F.array_sort(F.concat(*bare)).alias("base"),
                 F.transform("run", _tested).alias("run"))
    d = stored(d, "secrets")
    limits = _thresholds(d.select(F.explode("run").alias("r")).select("r.size", "r.bin"))
    d = d.crossJoin(F.broadcast(limits))
    found = F.filter("run", lambda r: r["bin"] >= F.coalesce(F.try_element_at("threshold", r["size"]), F.lit(MAX_BIN + 1)))
    added = _let(_apart(F.transform(found, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))), F.col("base")), _longest)
    return d.withColumn("spans", F.array_sort(F.concat("base", _of_kind(added, 3)))).drop("run", "threshold")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every maximal stretch of spans (sorted by start) replaced by a mark."""
    def cut(marks: Column) -> Column:
        def of_block(block: Column) -> Column:  # its stretch of the text is cut out once
            begin = block[0]["covered"]
            stretch = F.substring(text, (begin + 1).cast("int"), (F.element_at(block, -1)["start"] - begin).cast("int"))
            fresh = F.filter(block, lambda m: m["start"] >= m["covered"])
            return _let(stretch, lambda t: F.array_join(F.transform(fresh, lambda m: F.concat(F.substring(
                t, (m["covered"] - begin + 1).cast("int"), (m["start"] - m["covered"]).cast("int")), F.lit(MARK))), ""))
        rest = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(F.transform(_blocks(marks), of_block), ""), F.substring(text, (rest + 1).cast("int"), F.length(text)))

    covered = _before(F.transform(spans, lambda x: x["end"].cast("long")), F.lit(0).cast("long"), F.greatest)
    marks = F.zip_with(spans, covered, lambda x, c: F.struct(x["start"].cast("long").alias("start"), c.alias("covered")))
    return F.when(F.size(spans) == 0, text).otherwise(_let(marks, cut))


def redact_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All documents with their secrets replaced by a mark, in the columns of ``docs``."""
    found = scan_secrets(docs, doc_id, text, keep_row=True)
    clean = redact(F.col("row").getField(text), F.col("spans"))
    found = found.withColumn("clean", clean)
    cols = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text:
            value = F.col("clean")
        elif c == n_chars:
            value = F.when(F.size("spans") > 0, F.length("clean").cast(docs.schema[c].dataType)).otherwise(value)
        cols.append(value.alias(c))
    return found.select(*cols)
