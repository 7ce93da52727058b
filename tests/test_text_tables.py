"""documents of several text tables are read from their text in a stream; the first rows of a table are written once."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import ingest as ig
from marketlake.operators import store as st
from marketlake.operators.keyed_log import KeyedLog
from marketlake.plans import fixtures as fx
from marketlake.plans.clean_job import clean_documents
from marketlake.sources import documents as docsrc
from marketlake import catalog

REQUEST = {"payload": {"date": "20240102", "n": 1}, "freq": "D"}
ONE = {"title": "Quotes", "fields": ["代號", "v"], "data": [["1", "1,234.50"], ["2", None], ["\\u0041\n\"x\"", ""], None, []]}
LINES = {"subtitle1": "Lines", "fields1": ["a"], "data1": [["x"]]}
TEXT = [ONE, {**ONE, "data": [[]]}, {**ONE, "data": []}, {**ONE, "subtitle": "s"}, {**ONE, **LINES, "crawlerdic": REQUEST, "stat": "OK", "ok": True},
        {**ONE, **LINES, "tables": [ONE, {**ONE, "subtitle": "s", "total": 1}]}, {**ONE, "data1": [["5"]]}, {**ONE, "tables": [{**ONE, "data": []}, ONE]},
        {**ONE, **{f"{k}{n}": v for n in (2, 3, 5) for k, v in ONE.items()}}, {"fields": ["a"], "data": [["1"]]}, LINES, {"title": "t"},
        {**ONE, "data": [None]}, {**ONE, "tables": [{**ONE, "data": [["1", None], []]}], "data9": [["z"]]}]
OTHER = [{**ONE, "data": [["1", 1.50]]}, {**ONE, "data1": [["1", {"k": 1}]]}, {**ONE, "title": None}, {**ONE, "title": 7}, {**ONE, "fields1": None},
         {**ONE, "fields": [None]}, {**ONE, "tables": [ONE, "x"]}, {**ONE, "tables": []}, {**ONE, "tables": [ONE, None]}, {**ONE, "tables": [ONE, {**ONE, "title": None}]},
         {**ONE, "tables": [{"title": "t"}, {"fields": ["a"], "data": [["1"]]}, ONE]}, {**ONE, "tables": [ONE, {"x": 1}]}, {**ONE, "tables": [{**ONE, **LINES}]},
         {**ONE, "tables": [{**ONE, "notes": "n"}]}, {**ONE, "tables": ONE}, {"tables": [ONE]}, {**ONE, "notes": ["n"]}, {**ONE, "groups1": "g"},
         {**ONE, "data10": [["1"]]}, {**ONE, "creditList": [["9"]]}, {"fields5": ["a"], "data5": [["1"]]}, {"fields2": ["a"], "data2": [["1"]]}, [ONE], {}, "x"]


def _docs(spark, **how):
    texts = [json.dumps(b, ensure_ascii=i % 2 == 0) for i, b in enumerate(TEXT + OTHER)]
    texts += ["{", None, '{"title": "a", "fields": ["x"], "data": [["1"]], "data": [["2"]]}']
    rows = [("it", f"f{i:02d}", t) for i, t in enumerate(texts)]
    return docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"), **how)


def test_blocks_of_text_tables_are_the_same_as_from_the_variant(spark):
    got = _docs(spark, text_tables=True)
    assert sorted(r.source_file for r in got.where("text_tables is not null").collect()) == [f"f{i:02d}" for i in range(len(TEXT))]
    for keep_bare in (False, True):
        text, variant = (ig.extract_subtables(d, keep_bare=keep_bare).orderBy("source_file", "container", "kind", "k").collect()
                         for d in (got, _docs(spark)))
        assert len(variant) > 40 and text == variant
    text, variant = (d.drop("doc", "text_tables").orderBy("source_file").collect() for d in (got, _docs(spark)))
    assert text == variant


def test_filters_on_the_date_of_a_document_stand_below_the_explode_of_its_rows(spark):
    rows = [("it", f"f{i}", json.dumps({**ONE, "crawlerdic": {"payload": {"date": d}}})) for i, d in enumerate(("20240102", "2024-99-99", None))]
    docs = docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"), text_tables=True)
    res = clean_documents(docs, catalog.catalogue_frame(spark, [("it", "D", "2024-01-01", ["Quotes"], "Q")]))
    assert {(r.source_file, r.error.column, r.error.value, r.error.value_type) for r in res.errors.collect()} == {("f1", "date", "2024-99-99", "string")}
    assert res.errors.count() == len(ONE["data"])
    assert {(r["代號"], r.date, r.source_file) for r in res.tables["it", "Quotes"].collect()} >= {("1", dt.date(2024, 1, 2), "f0"), ("1", None, "f2")}
    plan = res.errors._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan[plan.rindex("date parse failed"):plan.rindex("Generate posexplode")]


def _rows(ids, year, v):
    return [(i, dt.date(year + i % 5, 5, 1 + i % 28), v) for i in ids]


def test_the_first_rows_of_a_table_are_written_once(spark, tmpdir_path, monkeypatch):
    path, schema, written = f"{tmpdir_path}/t", "id int, date date, v double", []
    write_range, replace_base = st._write_range, KeyedLog._replace_base
    monkeypatch.setattr(st, "MOVE_ROWS", 2, raising=False)
    monkeypatch.setattr(st, "_write_range", lambda *a, **k: written.append("rows") or write_range(*a, **k))
    monkeypatch.setattr(KeyedLog, "_replace_base", lambda log, *a: written.append(os.path.basename(log.path)) or replace_base(log, *a))
    first = spark.createDataFrame(_rows(range(200), 2020, 0.0) + _rows(range(100), 2020, 1.0), schema)
    got = st.upsert_into_table(spark, first.coalesce(1), path, ["id"], order_cols=["v"], batch_id=st.BatchId("s", 0))
    want = {i: (dt.date(2020 + i % 5, 5, 1 + i % 28), 1.0 if i < 100 else 0.0) for i in range(200)}
    assert {r.id: (r.date, r.v) for r in got.collect()} == want and got.count() == 200
    assert written == ["ledger"]  # neither rows nor keys a second time
    assert os.listdir(f"{path}/_staging") == [] and sorted(x for x in os.listdir(path) if x[0] == "b") == [f"bucket={2020 + k}" for k in range(5)]
    for bucket in range(2020, 2025):  # in the order of their dates
        for name in os.listdir(f"{path}/bucket={bucket}"):
            if name.endswith(".parquet"):
                dates = [r.date for r in spark.read.parquet(f"{path}/bucket={bucket}/{name}").collect()]
                assert dates == sorted(dates)
    # the key index that was moved in place is a base like any other: a key that moves leaves its bucket
    for again in range(2):
        got = st.upsert_into_table(spark, spark.createDataFrame([(0, dt.date(2023, 1, 1), 5.0), (1, dt.date(2021, 5, 2), 6.0)], schema), path, ["id"],
                                   order_cols=["v"], batch_id=st.BatchId("s", 1 + again))
        want = {**want, 0: (dt.date(2023, 1, 1), 5.0), 1: (dt.date(2021, 5, 2), 6.0)}
        assert {r.id: (r.date, r.v) for r in got.collect()} == want and got.count() == 200
    assert written.count("rows") == 2


def test_small_files_of_a_first_batch_are_put_together(spark, tmpdir_path, monkeypatch):
    written, write_range = [], st._write_range
    monkeypatch.setattr(st, "_write_range", lambda *a, **k: written.append("rows") or write_range(*a, **k))
    st.upsert_into_table(spark, spark.createDataFrame(_rows(range(20), 2020, 0.0), "id int, date date, v double"), f"{tmpdir_path}/t", ["id"])
    assert written == ["rows"] and spark.read.parquet(f"{tmpdir_path}/t").count() == 20


@pytest.mark.parametrize("cut", ["before", "after"])
def test_a_folder_of_keys_is_taken_once(spark, tmpdir_path, cut):
    log = KeyedLog(spark, f"{tmpdir_path}/log", ["k"], "k int, bucket string")
    spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, bucket string, was string").write.parquet(f"{tmpdir_path}/keys")
    if cut == "before":  # the mark was set, the folder not moved yet
        os.makedirs(f"{tmpdir_path}/keys/_log/base-000000000000")
    log.append_folder(f"{tmpdir_path}/keys", 0)
    assert {(r.k, r.bucket) for r in log.read().collect()} == {(1, "a"), (2, "b")} and log.next_generation() == 1
    assert not os.path.exists(f"{tmpdir_path}/keys")
    spark.createDataFrame([(2, "c", "b")], "k int, bucket string, was string").write.parquet(f"{tmpdir_path}/keys")
    log.append_folder(f"{tmpdir_path}/keys", 1)
    log.append_folder(f"{tmpdir_path}/keys", 1)
    assert {(r.k, r.bucket) for r in log.read().collect()} == {(1, "a"), (2, "c")}


def test_cells_of_line_items_are_printed_in_their_document(spark, tmpdir_path):
    day = dt.datetime(1999, 3, 4)
    spark.createDataFrame([(5, 7, "O", 1234.5, day, "1-URGENT"), (6, 8, "F", None, day, None), (None, 9, "P", 1.0, day, "x")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{tmpdir_path}/orders.parquet")
    li = [(5, 2, 3.0, 2000.0, 0.1, "N", day), (5, 1, None, None, None, "N", None), (5, 1, 2.0, 10.0, 0.0, None, dt.datetime(1905, 1, 2)), (None, 1, 1.0, 1.0, 1.0, "A", day)]
    spark.createDataFrame(li, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, "
                              "l_shipdate timestamp_ntz").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    docs = fx.landed_documents(spark, tmpdir_path)
    # what is shuffled to a document are stored values, not printed ones
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "format_number(l_extendedprice" not in plan[plan.index("Join LeftOuter"):]
    got = {r.source_file: json.loads(r.json) for r in docs.collect()}
    assert got[None]["data"] == [[None, "9", "P", "1.00", "x"]] and got[None]["data1"] == []
    (doc,) = [v for k, v in got.items() if k]
    assert doc["data"] == [["5", "7", "O", "1,234.50", "1-URGENT"], ["6", "8", "F", None, None]]
    assert doc["data1"] == [["5", "1", None, None, None, "N", "null/null/null"], ["5", "1", "2.0", "10.00", "0.0", None, "-6/01/02"],
                            ["5", "2", "3.0", "2,000.00", "0.1", "N", "88/03/04"]]
    assert doc["tables"][0]["data"] == [["5", None, "2.00", "1"], ["5", "N", "3.00", "2"]]
