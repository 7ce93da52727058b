import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators import store as st

D = dt.date


def test_keep_last_and_null_keys(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1, 10.0), ("a", D(2024, 1, 1), 2, 11.0),
                                (None, D(2024, 1, 1), 1, 1.0), (None, D(2024, 1, 1), 3, 3.0),
                                ("b", D(2024, 1, 2), 1, 5.0)], "code string, date date, seq int, v double")
    out = {(r.code, r.date): r.v for r in st.dedup_keep_last(df, ["code", "date"], ["seq"]).collect()}
    assert out == {("a", D(2024, 1, 1)): 11.0, (None, D(2024, 1, 1)): 3.0, ("b", D(2024, 1, 2)): 5.0}
    # incomplete key -> no-op
    assert st.dedup_keep_last(df, ["code", "nope"], ["seq"]).count() == 5
    assert st.infer_key(["代號", "date", "x"], code_col="代號") == ["代號", "date"]
    assert st.infer_key(["名稱", "date"], code_col="代號", name_col="名稱") == ["名稱", "date"]
    assert st.infer_key(["x"]) == []


def test_insert_only_null_safe(spark):
    ex = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    new = spark.createDataFrame([(None, 9.0), ("a", 9.0), ("b", 9.0)], "k string, v double")
    assert [r.k for r in st.insert_only_new_keys(ex, new, ["k"]).collect()] == ["b"]


def test_upsert_and_policy(spark):
    ex = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, seq int, v double")
    new = spark.createDataFrame([("a", 0, 9.0), ("c", 0, 3.0)], "k string, seq int, v double")
    up = {r.k: r.v for r in st.upsert(ex, new, ["k"], ["seq"]).collect()}
    assert up == {"a": 9.0, "b": 2.0, "c": 3.0}
    ins = {r.k: r.v for r in st.apply_write_policy(ex, new, ["k"], "ME", order_cols=["seq"]).collect()}
    assert ins == {"a": 1.0, "b": 2.0, "c": 3.0}
    flagged = {r.k: r.v for r in st.apply_write_policy(ex, new, ["k"], "ME", True, ["seq"]).collect()}
    assert flagged == up
    assert st.upsert(None, new, ["k"]).count() == 2


def test_latest_date_policy(spark):
    df = spark.createDataFrame([("f1", D(2024, 1, 1), 1), ("f1", D(2024, 1, 31), 2), ("f2", D(2024, 2, 1), 3)],
                               "source_file string, date date, v int")
    assert sorted(r.v for r in st.latest_date_only(df, freq="ME").collect()) == [2, 3]
    assert st.latest_date_only(df, freq="D").count() == 3
    assert st.latest_date_only(df, freq="ME", update_old_non_daily=True).count() == 3


def test_job_state(spark):
    old = spark.createDataFrame([("p1", "success", "2024-01-01", "x"), ("p2", "failed", "2024-01-02", "y")],
                                "path string, status string, date string, item string")
    new = spark.createDataFrame([("p2", "success", None, None), ("p3", "success", "2024-01-03", "z")],
                                "path string, status string, date string, item string")
    out = {r.path: (r.status, r.date, r.item) for r in st.upsert_job_state(old, new).collect()}
    assert out == {"p1": ("success", "2024-01-01", "x"), "p2": ("success", "2024-01-02", "y"),
                   "p3": ("success", "2024-01-03", "z")}
    files = spark.createDataFrame([("p1",), ("p2",), ("p4",)], "path string")
    r = st.pending_work(files, old).collect()[0]
    assert (r.n_files, r.n_pending) == (3, 2)


def test_change_detection(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    files = spark.createDataFrame([("p1", 10, t0), ("p2", 10, t0), ("p3", 10, t0)],
                                  "path string, size_bytes bigint, mtime timestamp")
    state = spark.createDataFrame([("p1", "10-1704103200", t0, "success"), ("p2", "11-1704103200", t0, "success")],
                                  "path string, hash string, source_mtime timestamp, status string")
    out = {r.path: (r.needs_processing, r.changed_since_success) for r in st.needs_processing(files, state).collect()}
    assert out == {"p1": (False, False), "p2": (True, True), "p3": (True, False)}
    assert st.any_pending(files, state)


def test_bucketed_upsert_is_idempotent(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    df = spark.createDataFrame([("a", D(2023, 5, 1), 1, 1.0), ("a", D(2024, 5, 1), 1, 2.0)],
                               "code string, date date, seq int, v double")
    st.upsert_into_table(spark, df, path, ["code", "date"], ["seq"], bucket_mode="year")
    st.upsert_into_table(spark, df, path, ["code", "date"], ["seq"], bucket_mode="year")
    assert spark.read.parquet(path).count() == 2
    upd = spark.createDataFrame([("a", D(2024, 5, 1), 2, 9.0)], "code string, date date, seq int, v double")
    st.upsert_into_table(spark, upd, path, ["code", "date"], ["seq"], bucket_mode="year")
    got = {(r.date, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {(D(2023, 5, 1), 1.0), (D(2024, 5, 1), 9.0)}
    assert sorted(r.bucket for r in spark.read.parquet(path).select("bucket").distinct().collect()) == ["2023", "2024"]


def test_table_upsert_loses_nothing(spark, tmpdir_path):
    import glob
    import pytest
    path = f"{tmpdir_path}/t"
    day = F.to_date(F.lit("2024-01-05"))
    first = spark.createDataFrame([(1, "keep"), (2, "keep")], "code int, b string").withColumn("date", day)
    st.upsert_into_table(spark, first, path, ["code", "date"])
    second = spark.createDataFrame([(3, 1.5), (None, 2.5)], "code int, c double").withColumn("date", day)
    got = st.upsert_into_table(spark, second, path, ["code", "date"])
    assert {(r.code, r.b, r.c) for r in got.collect()} == {(1, "keep", None), (2, "keep", None), (3, None, 1.5), (None, None, 2.5)}
    many = spark.range(20000).select(F.col("id").cast("int").alias("code"), F.lit("x").alias("b"), day.alias("date"))
    st.upsert_into_table(spark, many, f"{tmpdir_path}/m", ["code", "date"])
    assert len(glob.glob(f"{tmpdir_path}/m/bucket=*/*.parquet")) > 1
    for f in glob.glob(f"{path}/bucket=*/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"broken")
    with pytest.raises(Exception):
        st.upsert_into_table(spark, first, path, ["code", "date"])
    assert glob.glob(f"{path}/bucket=*/*.parquet")


def test_policy_keeps_unknown_items_and_null_documents(spark):
    dim = spark.createDataFrame([("d", "daily"), ("m", "M")], "item string, freq string")
    old = spark.createDataFrame([("d", 1, "old"), ("m", 1, "old"), ("unk", 1, "old")], "item string, k int, v string")
    new = spark.createDataFrame([("d", 1, "new"), ("m", 1, "new"), ("unk", 1, "new"), ("unk", 2, "new")], "item string, k int, v string")
    got = st.apply_write_policy_by_item(old, new, ["item", "k"], dim)
    assert {tuple(r) for r in got.select("item", "k", "v").collect()} == {("d", 1, "new"), ("m", 1, "old"), ("unk", 1, "new"), ("unk", 2, "new")}
    rows = spark.createDataFrame([("f", 1), ("f", 2), (None, 3)], "source_file string, date int")
    assert {tuple(r) for r in st.latest_date_only(rows, freq="M").collect()} == {("f", 2), (None, 3)}
