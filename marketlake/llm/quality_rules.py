"""Line-first cleaning with DataFrame functions only.

Every line of a text is judged on its own - punctuation, navigation and
boilerplate rules; failing lines are removed, then a document that lost too
much of its text is rejected.  Counts over words (duplicate lines, repeated
5-word windows) are taken inside the row, so nothing is shuffled and a very
long text costs one row's memory.  Repeated windows are found by sorting the row's window
hashes (64 bit) with their positions: n log n in the text's words.

Defined results: null text = empty text: no words, base_failed, not kept, null
stays null; a line without words is never removed and never a duplicate;
repeated rows are judged alike; ties cannot arise; empty table: no rows; other
columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANK, WORD, col, whole_row

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: a document is rejected when its removed lines hold more than this share of its word characters
MAX_LOST_PERCENT = 50

SYMBOLS = r"[#*$%&|<>]"

# Line rules.  The patterns repeat no groups: Java would recurse once per repetition on a long line.
#: navigation: at least three separators with at most four words to a cell
SEPARATOR = r"[|»›]"
MIN_SEPARATORS = 3
MAX_CELL_WORDS = 4
#: boilerplate phrases of page furniture
BOILERPLATE = (r"(?i)(all rights reserved|cookie policy|cookie settings|accept all cookies|accept cookies|"
               r"privacy policy|terms of use|terms of service|enable javascript|lorem ipsum|"
               r"subscribe to our newsletter|click here to|share this page|share this article)")
#: punctuation: words that drag symbols or several marks along, a quarter of the line's words
MARKS = r"[#*$%&<>]{2,}|[!?]{2,}"
MIN_MARKS = 3
#: punctuation: a line of this many words without any mark that ends or joins a clause
CLAUSE = r"[.!?;:,…。！？]"
MIN_UNPUNCTUATED_WORDS = 20


def line_fails(line: Column) -> Column:
    """True if a line breaks a rule (null-free boolean)."""
    n = F.regexp_count(line, F.lit(WORD))
    cells, marks = F.regexp_count(line, F.lit(SEPARATOR)), F.regexp_count(line, F.lit(MARKS))
    return (((cells >= MIN_SEPARATORS) & (n <= MAX_CELL_WORDS * (cells + 1)))
            | line.rlike(BOILERPLATE)
            | ((marks >= MIN_MARKS) & (4 * marks >= n))
            | (~line.rlike(CLAUSE) & (n >= MIN_UNPUNCTUATED_WORDS)))


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, BLANK + "+", ""))


def repeated_window_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array of window hashes."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    null_pair = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("i")))

    def positions(p: Column) -> Column:
        n = F.size(p)
        before = F.concat(null_pair, F.slice(p, 1, n - 1))
        after = F.concat(F.slice(p, 2, n - 1), null_pair)
        twin = F.arrays_zip(p.alias("p"), before.alias("b"), after.alias("a"))
        hit = F.filter(twin, lambda t: (t["p"]["h"] == t["b"]["h"]) | (t["p"]["h"] == t["a"]["h"]))
        return F.sort_array(F.transform(hit, lambda t: t["p"]["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                           lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"),
                                                 i.alias("last")), lambda s: s["n"])

    # one-element transforms bind each intermediate array once
    return F.transform(F.array(pairs), lambda p: covered(positions(p)))[0]


def judge_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: row (all input columns), clean_text, the counts, base_failed, kept."""
    d = docs.select(whole_row(docs).alias("row"), col(doc_id).alias("doc_id"),
                    F.coalesce(col(text), F.lit("")).alias("t"))
    d = d.withColumns({
        "words": F.transform(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)),
        "lines": F.transform(F.split("t", "\n", -1), lambda x: F.struct(
            x.alias("line"), x.rlike(BLANK[:-1].replace("[", "[^") + "]").alias("filled")))})
    n = F.size("words")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    d = d.withColumns({
        "n_words": n.cast("long"),
        "windows": F.transform(starts, lambda i: F.xxhash64(*[F.element_at("words", i + k) for k in range(WINDOW)])),
        "filled": F.transform(F.filter("lines", lambda x: x["filled"]), lambda x: x["line"]),
        "word_chars": _word_chars(F.col("t")).cast("long"),
        "n_symbols": F.regexp_count("t", F.lit(SYMBOLS)).cast("long"),
        "judged": F.transform("lines", lambda x: F.struct(
            x["line"].alias("line"), (x["filled"] & line_fails(x["line"])).alias("fails")))})
    d = d.withColumns({
        "n_dup_lines": (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long"),
        "n_repeat_words": F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long"))
        .otherwise(repeated_window_words(F.col("windows"))),
        "failing": F.filter("judged", lambda x: x["fails"])})
    d = d.withColumns({
        "n_failed_lines": F.size("failing").cast("long"),
        "lost_chars": F.aggregate("failing", F.lit(0).cast("long"),
                                  lambda s, x: s + _word_chars(x["line"]).cast("long")),
        "clean_text": F.when(F.size("failing") == 0, F.col("t")).otherwise(F.array_join(F.transform(
            F.filter("judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"))})
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return d.select("row", "doc_id", "clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "n_failed_lines", "lost_chars", "base_failed",
                    (~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars")))
                    .alias("kept"))


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    n_chars: str = "n_chars") -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of ``docs``."""
    # explode, not where: a filter would be pushed below the projections and inline them into itself
    kept = judge_lines(docs, doc_id, text).withColumn("one", F.explode(F.when(F.col("kept"), F.array(F.lit(1)))))
    cols = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text:
            value = F.col("clean_text")
        elif c == n_chars:
            value = F.when(F.col("n_failed_lines") > 0, F.length("clean_text").cast(docs.schema[c].dataType)).otherwise(value)
        cols.append(value.alias(c))
    return kept.select(*cols)
