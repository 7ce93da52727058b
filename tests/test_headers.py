"""Headers as column expressions against the rules on plain lists; the registry; many variants."""

import itertools
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import headers
from marketlake.operators import ingest as ig
from marketlake.plans.clean_job import clean_documents, header_registry, store_result
from marketlake.sources import documents as docsrc

SPANS = [("鍵", 0, 2), ("融資", 2, 4), ("融券", 4, 6), ("其他", 6, 7)]


def plain(fields, spans):
    """The final names by the rules on lists; None where they cannot be made unique."""
    cols = ig.grouped_header(fields, spans) if spans else fields
    cols = ig.normalize_names([f"_pad{i}" if c is None else c for i, c in enumerate(cols)], catalog.GLOBAL_RENAME)
    try:
        return ig.repair_duplicate_names(cols, [s[0] for s in spans] if spans else [])
    except ig.DataCleanError:
        return None


@pytest.mark.parametrize("spans", [None, SPANS])
def test_final_names_equal_the_rules_on_lists(spark, spans):
    rng = random.Random(2)
    pool = ["證券代號", "證券名稱", "日期", "a</br>b", "a", "a__2", "買進", "賣出", None, ""]
    cases = [[], ["a"], ["a", "a", "a__2"], ["買進"] * 4, ["證券代號", "證券名稱", "買進", "賣出", "買進", "賣出", "註"]]
    cases += [[rng.choice(pool) for _ in range(rng.randrange(1, 10))] for _ in range(400)]
    df = spark.createDataFrame([(c,) for c in cases], "fields array<string>")
    got = df.select("fields", headers.final_names(F.col("fields"), spans, catalog.GLOBAL_RENAME).alias("final")).collect()
    for r in got:
        assert r.final == plain(r.fields, spans), r.fields


def docs(spark, bodies):
    rows = [("it", f"src/it/{i:05d}.json", json.dumps(b, ensure_ascii=False)) for i, b in enumerate(bodies)]
    return docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"))


def body(fields, data):
    return {"title": "Quotes", "fields": fields, "data": data, "crawlerdic": {"payload": {"date": "20240102"}}}


def catalogue(spark):
    return catalog.catalogue_frame(spark, [("it", "D", "2024-01-01", ["Quotes"], "Q")])


def test_thousands_of_variants(spark):
    """Every permutation of seven columns: the plan does not grow with them, and every cell finds its column."""
    names = ["代號", "b", "c", "d", "e", "f", "g"]
    many = list(itertools.permutations(names))
    res = clean_documents(docs(spark, [body(list(p), [[f"{n}{i}" for n in p]]) for i, p in enumerate(many)]), catalogue(spark))
    few = clean_documents(docs(spark, [body(names, [[f"{n}0" for n in names]])]), catalogue(spark))
    assert res.registry.count() == len(many) == 5040
    size = lambda r: len(r.tables["it", "Quotes"]._jdf.queryExecution().analyzed().toString())
    assert size(res) == pytest.approx(size(few), rel=.05)
    t = res.tables["it", "Quotes"]
    t0 = time.time()
    t._jdf.queryExecution().executedPlan()
    assert time.time() - t0 < 20
    assert sorted(t.columns) == sorted(few.tables["it", "Quotes"].columns)
    wrong = F.lit(False)
    for n in names:
        wrong = wrong | ~F.startswith(F.col(n), F.lit(n)) | (F.substring(n, len(n) + 1, 9) != F.substring(F.col("代號"), 3, 9))
    assert t.count() == 5040 and t.where(wrong).count() == 0


def test_a_bad_header_costs_its_own_document(spark, tmpdir_path):
    good, surplus = body(["證券代號", "v", "v"], [["1", "2", "3"]]), body(["證券代號", "w"], [["2", "4", "surplus"], ["3"]])
    bad = body(["a", "a", "a__2"], [["1", "2", "3"]])
    res = clean_documents(docs(spark, [good, bad, surplus]), catalogue(spark))
    assert sorted((r["代號"], r.v, r.v__2, r.w) for r in res.tables["it", "Quotes"].collect()) == [
        ("1", "2", "3", None), ("2", None, None, "4"), ("3", None, None, None)]
    (error,) = [r.error for r in res.errors.collect()]
    assert (error.message, error.value, error.value_type, error.date, error.subitem) == (headers.BAD_HEADER, "a,a,a__2", "string", "20240102", "Quotes")
    with pytest.raises(ig.DataCleanError):
        clean_documents(docs(spark, [bad]), catalogue(spark), strict=True)
    for batch in ("b0", "b1"):
        store_result(spark, res, f"{tmpdir_path}/t", {"it": "D"}, batch)
    kept = header_registry(spark, f"{tmpdir_path}/t").history().collect()
    assert sorted((r.fields, r.final, r.n_blocks) for r in kept) == [
        (["證券代號", "v", "v"], ["代號", "v", "v__2"], 1), (["證券代號", "w"], ["代號", "w"], 1)]
    assert len({r.variant for r in kept}) == 2


def test_errors_name_type_and_date(spark):
    res = clean_documents(docs(spark, [body(["證券代號", "日期"], [["1", "not a date"]])]), catalogue(spark))
    (error,) = [r.error for r in res.errors.collect()]
    assert (error.column, error.value, error.value_type, error.date) == ("date", "not a date", "string", "20240102")
