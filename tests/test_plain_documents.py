"""Plain documents are read from their text, all others from their VARIANT: the blocks are the same either way."""

import json

from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import ingest as ig
from marketlake.plans.clean_job import clean_documents
from marketlake.sources import documents as docsrc

REQUEST = {"payload": {"date": "20240102", "n": 1}, "freq": "D"}
TABLE = {"title": "Quotes", "fields": ["代號", "v"], "data": [["1", "1,234.50"], ["2", None], ["\\u0041\n\"x\"", ""], None, []]}
PLAIN = [TABLE, {**TABLE, "crawlerdic": REQUEST, "stat": "OK", "total": 2, "rate": 1.5, "none": None, "ok": True}]
OTHER = [{**TABLE, "data": [["1", 1.50]]}, {**TABLE, "data": [["1", {"k": 1}], [[2], True]]}, {**TABLE, "data": [[]]}, {**TABLE, "data": "[[1]]"},
         {**TABLE, "fields": ["a", 1.50]}, {**TABLE, "fields": [None]}, {**TABLE, "title": None}, {**TABLE, "title": 7}, {**TABLE, "subtitle": "s"},
         {**TABLE, "fields1": ["b"], "data1": [["5"]]}, {**TABLE, "creditList": [["9"]]}, {**TABLE, "tables": [TABLE, "x"]}, {**TABLE, "notes": "n"},
         {**TABLE, "groups": [1]}, {"fields": ["a"], "data": [["1"]]}, {"fields5": ["a"], "data5": [["1"]]}, {"nested": TABLE},
         {**TABLE, "nested": TABLE}, {**TABLE, "crawlerdic": {"payload": {"date": 20240102}}}, [1], {}, {**TABLE, "a b": "x"}]


def _docs(spark, plain):
    texts = [json.dumps(b, ensure_ascii=i % 2 == 0) for i, b in enumerate(PLAIN + OTHER)]
    texts += ["{", None, '{"title": "a", "title": "b", "fields": ["x"], "data": [["1"]]}', json.dumps(TABLE) + " x"]
    rows = [("it", f"f{i:02d}", t) for i, t in enumerate(texts)]
    return docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"), plain=plain)


def test_only_plain_documents_are_read_from_their_text(spark):
    got = _docs(spark, True).where("plain is not null").orderBy("source_file").collect()
    # f27: neither reader looks at what stands behind a document
    assert [r.source_file for r in got] == ["f00", "f01", "f27"] and [r.date_key for r in got] == [None, "20240102", None]
    assert got[0].plain.data == [["1", "1,234.50"], ["2", None], ["\\u0041\n\"x\"", ""], None, []]


def test_blocks_are_the_same_as_from_the_variant(spark):
    for keep_bare in (False, True):
        text, variant = (ig.extract_subtables(_docs(spark, p), keep_bare=keep_bare).orderBy("source_file", "container", "kind", "k").collect()
                         for p in (True, False))
        assert len(variant) > 20 and text == variant
    text, variant = (_docs(spark, p).drop("doc", "plain").orderBy("source_file").collect() for p in (True, False))
    assert text == variant


def test_the_usual_header_and_a_rare_one_meet_in_one_table(spark):
    usual = [{"title": "Quotes", "fields": ["證券代號", "v", "v"], "data": [[str(i), "a", "b", "surplus"], [f"{i}x"]]} for i in range(3)]
    rare = [{"title": "Quotes", "fields": ["v", "證券代號"], "data": [["c", "9"]]}, {"title": "Quotes", "fields": ["v", None], "data": [["d", "e"]]},
            {"title": "Quotes", "fields": ["a", "a", "a__2"], "data": [["1", "2", "3"]]}]
    rows = [("it", f"f{i}", json.dumps({**b, "crawlerdic": REQUEST})) for i, b in enumerate(usual + rare)]
    docs = docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"), plain=True)
    res = clean_documents(docs, catalog.catalogue_frame(spark, [("it", "D", "2024-01-01", ["Quotes"], "Q")]))
    table = res.tables["it", "Quotes"]
    # the places of the usual header stand in the plan
    assert "證券代號" in table._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(((r["代號"], r.v, r.v__2) for r in table.collect()), key=str)
    assert got == sorted([(x, v, w) for i in range(3) for x, v, w in ((str(i), "a", "b"), (f"{i}x", None, None))]
                         + [("9", "c", None), (None, "d", None)], key=str)
    (error,) = res.errors.collect()
    assert (error.source_file, error.error.message, error.error.value) == ("f5", "duplicate column names cannot be repaired", "a,a,a__2")
    assert res.registry.where(F.col("final").isNull()).count() == 0 and res.registry.count() == 3
