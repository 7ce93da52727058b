"""Values of documents and rows are read once, whatever filters stand above them."""

import datetime as dt
import json

import pyarrow as pa
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.functions import scalars as S
from marketlake.operators import headers
from marketlake.operators import ingest as ig
from marketlake.operators import store as st
from marketlake.operators.keyed_log import KeyedLog
from marketlake.plans import fixtures as fx
from marketlake.plans.clean_job import clean_documents
from marketlake.sources import documents as docsrc


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _docs(spark, *texts):
    rows = [("it", f"f{i}", t) for i, t in enumerate(texts)]
    return docsrc.documents_from_text(spark.createDataFrame(rows, "item string, source_file string, json string"))


def test_block_values_are_read_in_the_document_row(spark):
    docs = _docs(spark, '{"title": "a", "fields": ["x", 1.50], "data": [["1", null], [2.5, {"k": 1}]], "data2": [["z"]], "fields2": []}')
    blocks = ig.skip_empty(ig.extract_subtables(docs))
    above = _plan(blocks).split("Generate explode")[0]
    assert "try_variant_get" not in above
    row = blocks.collect()
    assert [(r.k, r.title, r.fields, r.data) for r in row] == [(0, "a", ["x", "1.5"], [["1", None], ["2.5", '{"k":1}']])]


def test_keys_of_a_document_are_read_once(spark):
    keys = ig.classify_keys(_docs(spark, '{"title": 1, "datalist": 2, "fields": 3}'))
    assert _plan(keys).count("map_keys(") == 1
    assert sorted((r.key, r.key_class) for r in keys.collect()) == [("datalist", "value"), ("fields", "col"), ("title", "title")]


def test_usual_dates_are_cast_and_agree_with_the_formatters(spark):
    texts = ["20010203", "90/2/3", "090/02/03", "2001-2-3", "2001/02/3", "2001/2-3", " 2001-02-03 ", "20011301", "99/13/1", "2001-02-30x",
             "2001-02-03\n", "00000101", "0000-01-01", "2001-002-3", "1/2/3", "", None, "text", "2001-02", "20010203T", "000/01/01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", ig.parse_any_date(F.col("t")).cast("string").alias("got"), ig._formatted_date(F.trim("t")).cast("string").alias("want")).collect()
    assert [(r.t, r.got) for r in out] == [(r.t, r.want) for r in out]
    assert sum(r.got is not None for r in out) >= 8


def test_headers_without_repeats_need_no_ranks(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "a"],), ([],), (None,)], "n array<string>")
    out = [r.r for r in df.select(headers.repaired(F.col("n"), []).alias("r")).collect()]
    assert out == [["a", "b"], ["a", "b", "a__2"], [], None]


def test_keep_last_carries_each_value_once(spark):
    df = spark.createDataFrame([("k", 1, "x", "f1"), ("k", 2, "a", "f1"), ("k", 2, "b", "f1"), (None, 1, "n", "f2"), (None, 1, None, "f2")],
                               "k string, seq int, v string, file string")
    out = st.dedup_keep_last(df, ["k"], ["file", "seq"])
    assert out.columns == df.columns
    aggregate = next(line for line in _plan(out).splitlines() if "max(struct(" in line)
    assert aggregate.count("file, file#") + aggregate.count("seq, seq#") == 0
    assert sorted((r.k or "", r.seq, r.v, r.file) for r in out.collect()) == [("", 1, "n", "f2"), ("k", 2, "b", "f1")]
    keys_only = st.dedup_keep_last(df.select("k"), ["k"], [])
    assert sorted(r.k or "" for r in keys_only.collect()) == ["", "k"]


def test_nfkc_passes_batches_of_nulls(spark):
    nulls = pa.array([None, None], pa.string())
    assert S.nfkc.func(nulls) is nulls
    df = spark.createDataFrame([("Ａ　",), (None,), ("a",)], "t string")
    assert [r.n for r in df.select(S.nfkc("t").alias("n")).collect()] == ["A ", None, "a"]


def test_the_key_index_is_read_once_a_batch(spark, tmpdir_path, monkeypatch):
    path, schema, year = f"{tmpdir_path}/t", "id int, date date, v double", lambda y: dt.date(y, 5, 1)
    st.upsert_into_table(spark, spark.createDataFrame([(k, year(2020 + k % 2), 0.0) for k in range(100)], schema), path, ["id"])
    read, seen = KeyedLog.read, spark.sparkContext.accumulator(0)

    def counted(log):
        if not log.path.endswith("/_index/keys"):
            return read(log)

        @F.udf("string")
        def tell(bucket):
            seen.add(1)
            return bucket
        return read(log).withColumn("bucket", tell.asNondeterministic()("bucket"))
    monkeypatch.setattr(KeyedLog, "read", counted)
    got = st.upsert_into_table(spark, spark.createDataFrame([(0, year(2023), 1.0), (101, year(2021), 2.0)], schema), path, ["id"])
    assert seen.value == 100
    rows = {r.id: (r.date, r.v) for r in got.collect()}
    assert len(rows) == got.count() == 101 and rows[0] == (year(2023), 1.0) and rows[101] == (year(2021), 2.0)


def test_rows_of_a_base_take_no_number_from_their_path(spark, tmpdir_path):
    log = KeyedLog(spark, f"{tmpdir_path}/log", ["k"], "k int, v string")
    log.append(spark.createDataFrame([(k, "a") for k in range(40)], log.schema))
    assert "regexp_extract" not in log.history()._jdf.queryExecution().optimizedPlan().toString()
    log.append(spark.createDataFrame([(1, "b"), (None, "c")], log.schema))
    log.append(spark.createDataFrame([(1, "d")], log.schema))
    assert sorted((r["_gen"], r.k is None, r.k, r.v) for r in log.history().where("_gen >= 0 or k = 1").collect()) == [
        (-1, False, 1, "a"), (1, False, 1, "b"), (1, True, None, "c"), (2, False, 1, "d")]
    got = {r.k: r.v for r in log.read().collect()}
    assert len(got) == 41 and got[1] == "d" and got[None] == "c" and got[0] == "a"


def test_landed_documents_join_the_line_items_once(spark, tmp_path):
    day = dt.datetime(1996, 1, 2)
    spark.createDataFrame([(1, 7, "F", 1234.5, day, "1-URGENT"), (1, 8, "O", 2.0, day, "2-HIGH"), (2, None, None, None, day, None)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 2, "A", 1.5), (1, 1, "A", 2.0), (1, 1, "A", 2.0), (1, None, "R", None), (1, 3, None, 4.0), (None, 1, "A", 9.0)]
    spark.createDataFrame([(k, n, q, 10.0, 0.1, f, day) for k, n, f, q in lines],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, "
                          "l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    docs = fx.landed_documents(spark, str(tmp_path))
    assert sum("l_linenumber" in x for x in _plan(docs).splitlines() if "Relation [" in x) == 1
    assert sum("l_orderkey" in x for x in _plan(docs).splitlines() if "Relation [" in x) == 1
    doc, = [json.loads(r.json) for r in docs.collect()]
    # an order that stands twice meets each of its lines twice
    assert doc["tables"][0]["data"] == [["1", None, "8.00", "2"], ["1", "A", "11.00", "6"], ["1", "R", None, "2"]]
    assert [r[1] for r in doc["data1"]] == [None, None, "1", "1", "1", "1", "2", "2", "3", "3"]
    assert [r[0] for r in doc["data"]] == ["1", "1", "2"]


def test_keep_last_of_a_table_does_not_carry_its_constants(spark):
    docs = _docs(spark, *['{"title": "t", "fields": ["code", "v"], "data": [["a", "%d"], ["b", "0"]], "crawlerdic": {"payload": {"date": "20010203"}}}' % i
                          for i in (1, 2)])
    cat = catalog.catalogue_frame(spark, [("it", "D", "2000-01-01", ["t"], "X")])
    table = clean_documents(docs, cat, {"t": ig.TableSpec(item="it", subitem="t", pk=["code"])}).tables["it", "t"]
    aggregate = next(line for line in _plan(table).splitlines() if "max(struct(" in line)
    assert not any(f", {c}, " in aggregate.split("max(struct(")[1] for c in ("item", "subitem"))
    assert sorted((r.code, r.v, r.item, r.subitem, r.source_file) for r in table.collect()) == [
        ("a", "2", "it", "t", "f1"), ("b", "0", "it", "t", "f1")]
    # a key that names them still holds
    keyed = clean_documents(docs, cat, {"t": ig.TableSpec(item="it", subitem="t", pk=["item", "code"])}).tables["it", "t"]
    assert keyed.columns == table.columns and keyed.count() == 2
