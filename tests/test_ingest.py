import json

import pytest
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import ingest as ig
from marketlake.plans.clean_job import clean_documents
from marketlake.sources import documents as docsrc


def docs_of(spark, items):
    rows = [(item, f"src/{item}/{i}.json", json.dumps(d, ensure_ascii=False)) for i, (item, d) in enumerate(items)]
    return docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"))


def blocks(spark, doc):
    b = ig.extract_subtables(docs_of(spark, [("it", doc)]))
    return sorted((r.container, r.kind, r.k, r.title) for r in b.collect())


def test_numbering_gaps_and_nesting(spark):
    doc = {"fields1": ["a"], "data1": [["1"]], "subtitle1": "one",
           "fields2": ["a"], "data2": [["2"]], "title2": "two", "subtitle2": "ignored",
           "fields4": ["a"], "data4": [["4"]],          # gap at 3 -> not read
           "creditFields": ["c"], "creditList": [["9"]], "creditTitle": "credit",
           "tables": [{"title": "t0", "fields": ["x"], "data": [["5"]]}, "not a dict"],
           "crawlerdic": {"payload": {"date": "20240102"}}}
    assert blocks(spark, doc) == [(0, "credit", 0, "credit"), (0, "main", 1, "one"), (0, "main", 2, "two"),
                                  (1, "main", 0, "t0")]


def test_legacy_fallback(spark):
    # nothing at 0, 1, 2 -> main scan stops; legacy fieldsN/dataN scan takes over
    doc = {"fields5": ["a"], "data5": [["1"]], "subtitle5": "five", "fields7": ["a"], "data7": []}
    assert blocks(spark, doc) == [(0, "legacy", 5, "five")]


def test_high_numbers(spark):
    doc = {f"fields{k}": ["a"] for k in range(1, 14)} | {"title99999999999999999999": "x", "data99999999999": [["1"]]}
    assert blocks(spark, doc) == [(0, "main", k, None) for k in range(1, 14)]
    legacy = {"fields3000000000": ["a"], "data3000000000": [["1"]], "subtitle3000000000": "far"}
    assert blocks(spark, legacy) == [(0, "legacy", 3000000000, "far")]


def test_key_classes(spark):
    d = docs_of(spark, [("it", {"fields": ["a"], "creditList": [["1"]], "dataTitle": "t"}), ("it", [1])])
    got = sorted((r.key, r.key_class) for r in ig.classify_keys(d).collect())
    assert got == [("creditList", "value"), ("dataTitle", "title"), ("dataTitle", "value"), ("fields", "col")]
    t = ig.tables_by_key_class(docs_of(spark, [("it", {"fields": ["a"], "creditList": [["1"]], "creditTitle": "t"})]))
    assert [(r.n, r.title, r.fields, r.data) for r in t.collect()] == [(1, "t", ["a"], [["1"]])]


def test_same_title_in_two_items_and_shipped_types(spark):
    cat = catalog.catalogue_frame(spark)
    quotes = {"title": "112年 價格指數(跨市場)", "fields": ["指數", "收盤指數", "漲跌(+/-)"],
              "data": [["x", "1,000.5", "+", "surplus"]], "crawlerdic": {"payload": {"date": "20240102"}}}
    credit = {"title": "信用交易統計", "fields": ["項目", "買進"], "data": [["y", "7"]],
              "crawlerdic": {"payload": {"date": "20240102"}}}
    res = clean_documents(docs_of(spark, [("每日收盤行情", quotes), ("信用交易統計", credit)]), cat)
    assert sorted(res.tables) == [("信用交易統計", "信用交易統計"), ("每日收盤行情", "價格指數_跨市場")]
    q = res.tables["每日收盤行情", "價格指數_跨市場"]
    assert q.columns[:3] == ["date", "名稱", "收盤指數"] and "漲跌(+/-)" not in q.columns
    assert [r["收盤指數"] for r in q.collect()] == [1000.5]
    two = catalog.catalogue_frame(spark, [("a", "D", "2024-01-01", ["Same"], "A"), ("b", "D", "2024-01-01", ["Same"], "B")])
    doc = {"title": "Same", "fields": ["證券代號"], "data": [["1"]], "crawlerdic": {"payload": {"date": "20240102"}}}
    res = clean_documents(docs_of(spark, [("a", doc), ("b", doc)]), two)
    assert {k: t.count() for k, t in res.tables.items()} == {("a", "Same"): 1, ("b", "Same"): 1}


def test_title_null_is_present(spark):
    doc = {"title": None, "subtitle": "sub", "fields": ["a"], "data": [["1"]]}
    assert blocks(spark, doc) == [(0, "main", 0, None)]


def test_header_helpers():
    assert ig.normalize_names(["a</br>b", "日期"], catalog.GLOBAL_RENAME) == ["ab", "date"]
    assert ig.repair_duplicate_names(["a", "b", "a", "a"]) == ["a", "b", "a__2", "a__3"]
    assert ig.repair_duplicate_names([]) == [] and ig.repair_duplicate_names(["x", "y"], ["g", "h"]) == ["x", "y"]
    with pytest.raises(ig.DataCleanError):
        ig.repair_duplicate_names(["a", "a", "a__2"])
    cols = ["代號", "名稱", "買進", "賣出", "買進", "賣出"]
    assert ig.repair_duplicate_names(cols, ["融資", "融券"]) == ["代號", "名稱", "融資_買進", "融資_賣出", "融券_買進", "融券_賣出"]
    assert ig.repair_duplicate_names(cols[:5], ["融資", "融券"]) == ["代號", "名稱", "買進", "賣出", "買進__2"]
    spans = catalog.FIELD_SPANS["信用額度總量管制餘額表"]
    hdr = ig.grouped_header([f"c{i}" for i in range(15)], spans)
    assert hdr[:3] == ["c0", "c1", "融券_c2"] and hdr[8] == "借券賣出_c8" and hdr[14] == "c14"
    assert len(ig.grouped_header(["a", "b"], [("x", 0, 1), ("y", 1, 4)])) == 4


def test_clean_end_to_end_with_errors(spark):
    cat = catalog.catalogue_frame(spark, [("it", "D", "2024-01-01", ["Quotes", "Totals"], "Q")])
    good = {"title": "113年01月02日 Quotes", "fields": ["證券代號", "名稱", "收盤價", "收盤價", "日期"],
            "data": [["0050", "ETF", "1,234.5", "1", "113/01/02", "extra"], ["0051", "X", "--", "2"],
                     ["0050", "ETF", "99", "3", "113/01/02"]],
            "fields1": ["名稱", "成交金額(元)"], "data1": [["all", "1,000"]], "subtitle1": "Totals",
            "crawlerdic": {"payload": {"date": "20240102"}}}
    bad_title = {"title": "unknown table", "fields": ["a"], "data": [["1"]]}
    specs = {"Quotes": ig.TableSpec(item="it", subitem="Quotes", float_cols=["收盤價"], date_cols=["date"]),
             "Totals": ig.TableSpec(item="it", subitem="Totals", int_cols=["成交金額_元"])}
    res = clean_documents(docs_of(spark, [("it", good), ("it", bad_title), ("it", [1, 2])]), cat, specs,
                          global_rename=catalog.GLOBAL_RENAME)
    q = res.tables["it", "Quotes"].orderBy("代號").collect()
    # duplicate header repaired with a suffix; keep-last on (代號, date); short row -> NULL cells
    assert [(r["代號"], r["收盤價"], r["收盤價__2"]) for r in q] == [("0050", 99.0, "3"), ("0051", None, "2")]
    t = res.tables["it", "Totals"].collect()
    assert t[0]["成交金額_元"] == 1000 and str(t[0]["date"]) == "2024-01-02"
    msgs = sorted(r.error.message for r in res.errors.collect())
    assert msgs == ["document is not an object", "no configured subtitle in title"]
    with pytest.raises(ig.DataCleanError):
        clean_documents(docs_of(spark, [("it", bad_title)]), cat, specs, strict=True)


def test_subtitle_hits(spark):
    df = spark.createDataFrame([("it", "ＡＢＣ daily"), ("it", "AB"), ("it", "ABC and XYZ"), ("it", None), ("zz", "ABC")],
                               "item string, title string")
    got = {r.title: (r.subitem, r.match_error) for r in ig.match_titles(df, {"it": ["ABC", "XYZ"]}).collect()}
    assert got["ＡＢＣ daily"] == ("ABC", None)
    assert got["AB"][1] == "no configured subtitle in title"
    assert got["ABC and XYZ"][1] == "several configured subtitles in title"
    assert got[None][1] == "title is null"


def test_file_scan(spark, tmpdir_path):
    import os
    os.makedirs(f"{tmpdir_path}/it", exist_ok=True)
    os.makedirs(f"{tmpdir_path}/log", exist_ok=True)
    with open(f"{tmpdir_path}/it/it_20240102.json", "w") as fh:
        json.dump({"fields": ["a"], "data": [["1"]], "crawlerdic": {"payload": {"date": "20240102"}}}, fh)
    with open(f"{tmpdir_path}/log/x.json", "w") as fh:
        fh.write("{}")
    d = docsrc.read_landed_documents(spark, tmpdir_path).collect()
    assert [(r.item, r.date_key, r.is_object) for r in d] == [("it", "20240102", True)]
