import datetime as dt
import os
import time

from pyspark.sql import functions as F

from marketlake.operators import inventory as inv
from marketlake.sources.manifest import scan_manifest


def touch(path, size, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"x" * size)
    os.utime(path, (mtime, mtime))


def test_manifest_freshness_reconciliation(spark, tmpdir_path):
    today = dt.date(2024, 1, 10)
    t = lambda d, h=12: time.mktime(dt.datetime(2024, 1, d, h).timetuple()) - time.timezone  # UTC
    src, cln = f"{tmpdir_path}/source", f"{tmpdir_path}/cleaned"
    touch(f"{src}/A/A_1.parquet", 10, t(9))
    touch(f"{src}/A/A_2.parquet", 10, t(2))
    touch(f"{src}/B/B_1.parquet", 10, t(8))
    touch(f"{cln}/A/A_1.parquet", 20, t(9, 13))
    touch(f"{cln}/A/schema/A_schema.parquet", 5, t(9))
    touch(f"{cln}/C/C_1.parquet", 20, t(10, 8))      # touched "today" -> lag -1
    touch(f"{src}/top_level.parquet", 1, t(9))        # not below an item folder: ignored
    sd = inv.with_freshness(scan_manifest(spark, src, "source"), today, detect_schema=False)
    cd = inv.with_freshness(scan_manifest(spark, cln, "cleaned"), today)
    lag = {(r.item, r.subitem): (r.days_lag, r.status) for r in sd.collect()}
    assert lag == {("A", "A_1"): (0, "OK"), ("A", "A_2"): (7, "STALE"), ("B", "B_1"): (1, "OK")}
    c = {(r.item, r.subitem): (r.days_lag, r.is_schema) for r in cd.collect()}
    assert c[("C", "C_1")] == (-1, False) and c[("A", "A_schema")][1] is True
    rel = inv.merge_source_cleaned(sd, cd)
    got = {(r.item, r.subitem): r.relation for r in rel.collect()}
    assert got == {("A", "A_1"): "both", ("A", "A_2"): "source_only", ("B", "B_1"): "source_only",
                   ("C", "C_1"): "cleaned_only"}
    diff = [r.mtime_diff_days for r in rel.where("relation = 'both'").collect()][0]
    assert abs(diff - 1 / 24) < 1e-9
    orphan_true, orphan_all = inv.split_orphan_pairs_by_item(rel)
    assert [r.item for r in orphan_true.collect()] == ["C"]
    csum = {r.item: (r.n_files, r.n_schema_files, r.has_schema) for r in inv.summarize_cleaned_by_item(cd).collect()}
    assert csum == {"A": (1, 1, True), "C": (1, 0, False)}
    assert scan_manifest(spark, f"{tmpdir_path}/missing").count() == 0


def test_schema_only_items(spark):
    rows = [("cleaned", "S", "s", "x/S/schema/s.json", 1.0, dt.datetime(2024, 1, 1))]
    cd = inv.with_freshness(spark.createDataFrame(rows, "layer string, item string, subitem string, path string, "
                                                        "size_mb double, mtime timestamp"), "2024-01-02")
    s = inv.summarize_cleaned_by_item(cd).collect()
    assert [(r.item, r.n_files, r.n_schema_files, r.has_schema) for r in s] == [("S", 0, 1, True)]


def test_error_flatten_generations(spark):
    cells = spark.createDataFrame(
        [("2024-01-01", "A", [("timeout", "m1", None, None, ""), (None, None, "", "old", "msg2")])],
        "date string, item string, errors array<struct<error_reason:string, error_message:string, "
        "errormessage3:string, errormessage1:string, errormessage2:string>>")
    flat = inv.flatten_error_log(cells).collect()
    assert [(r.error_reason, r.error_message) for r in flat] == [("timeout", "m1"), ("old", "msg2")]
    empty = cells.withColumn("errors", F.array().cast(cells.schema["errors"].dataType))
    assert inv.flatten_error_log(empty).count() == 0


def test_error_statistics(spark):
    """T3 order, A9 dates per item, D2 over bare values."""
    cells = spark.createDataFrame([("2024-01-02", "a", ["boom", "bang"]), ("2024-01-01", "b", ["x"])],
                                  "date string, item string, errors array<string>")
    flat = inv.flatten_error_log(cells.withColumn("date", F.to_date("date")))
    assert {(r.item, r.error_reason, r.error_message) for r in flat.collect()} == {("a", "unknown", ""), ("b", "unknown", "")}
    assert [(r["item"], r["count"]) for r in inv.error_reason_stats(flat).collect()] == [("a", 2), ("b", 1)]
    assert [str(r.date) for r in inv.error_date_stats(flat).collect()] == ["2024-01-01", "2024-01-02"]
    logged = flat.withColumn("log_date", F.when((F.col("item") == "a") & (F.rand(1) < 2), F.to_date(F.lit("2024-03-01"))))
    rows = {r.item: (str(r.first_date), str(r.last_date)) for r in inv.error_profile_by_item(logged.unionByName(
        logged.where("item = 'a'").withColumn("log_date", F.lit(None).cast("date")))).collect()}
    assert rows == {"a": ("2024-03-01", "2024-03-01"), "b": ("2024-01-01", "2024-01-01")}


def test_schema_only_beside_data(spark):
    """A2: items with schema files only appear only where no item has a data file."""
    rows = [("a", "_schema", "a/schema/_schema.json", dt.datetime(2024, 1, 1), True, 1, "OK"),
            ("b", "x", "b/x.parquet", dt.datetime(2024, 1, 2), False, 0, "OK"),
            ("b", "_schema", "b/schema/_schema.json", dt.datetime(2024, 1, 1), True, 1, "OK")]
    d = spark.createDataFrame(rows, "item string, subitem string, path string, mtime timestamp, is_schema boolean, "
                                    "days_lag bigint, status string")
    got = [(r.item, r.n_files, r.n_schema_files, r.has_schema) for r in inv.summarize_cleaned_by_item(d).collect()]
    assert got == [("b", 1, 1, True)]
    only = {(r.item, r.n_files, r.n_schema_files, r.max_days_lag)
            for r in inv.summarize_cleaned_by_item(d.where("is_schema")).collect()}
    assert only == {("a", 0, 1, None), ("b", 0, 1, None)}
    assert inv.summarize_cleaned_by_item(d.limit(0)).collect() == []


def test_dashboard_is_released(spark):
    from marketlake import catalog
    from marketlake.plans import fixtures as fx
    from marketlake.plans.dashboard import build_dashboard
    base = "/root/testdata/sf0.001"
    with build_dashboard(spark, fx.source_manifest(spark, base), fx.cleaned_manifest(spark, base),
                         catalog.catalogue_frame(spark), "2001-08-03") as dash:
        source, cleaned = inv.summarize_source_by_item(dash["source_detail"]), inv.summarize_cleaned_by_item(dash["cleaned_detail"])
        for name, want in (("source_item_summary", source), ("cleaned_item_summary", cleaned),
                           ("schema_item_summary", inv.schema_count_by_item(dash["cleaned_detail"]))):
            assert sorted(map(tuple, dash[name].select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
        folder = dash.folder.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not dash and not os.path.exists(folder)


def test_reasons_in_first_seen_order(spark):
    rows = [("2024-01-02", "x", [("b", 1), ("a", 2)]), ("2024-01-01", "x", [("c", 5)]), ("2024-01-02", "x", [("d", 0), ("b", 3)]), ("2024-01-01", "y", [(None, 1)])]
    cells = spark.createDataFrame(rows, "date string, item string, errors array<struct<error_reason:string,seq:int>>").withColumn("date", F.to_date("date"))
    flat = inv.flatten_error_log(cells, order_field="seq")
    got = {r.item: (r.reasons, r.n_errors, r.n_more_reasons) for r in inv.error_profile_by_item(flat).collect()}
    assert got == {"x": (["c", "d", "b", "a"], 5, 0), "y": (["unknown"], 1, 0)}
    few = {r.item: (r.reasons, r.n_errors, r.n_more_reasons) for r in inv.error_profile_by_item(flat, max_reasons=2).collect()}
    assert few["x"] == (["c", "d"], 5, 2)
