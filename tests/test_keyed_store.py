"""Keys that change buckets, staged writes that are cut off, keyed logs, batch ledgers and late monthly data in a stream."""

import datetime as dt
import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from marketlake.operators import store as st
from marketlake.operators.keyed_log import KeyedLog, move_folder
from marketlake.plans import fixtures as fx
from marketlake.plans import q_extras
from marketlake.plans.clean_job import run_clean_job
from marketlake.streaming.ingest_stream import clean_batch_writer, start_ingest_stream, stream_id

SCHEMA = "id int, date date, v double"


def day(y, m=1, d=1):
    return dt.date(y, m, d)


def rows_of(df):
    return sorted((r.id, r.date, r.v) for r in df.collect())


def files_of(path, bucket):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket={bucket}/*.parquet")}


def test_a_key_moves_over_a_year_border(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    first = [(1, day(2023, 12, 31), 1.0), (2, day(2023, 6, 1), 2.0), (3, day(2022), 3.0), (4, day(2021), 4.0), (None, day(2022), 9.0)]
    st.upsert_into_table(spark, spark.createDataFrame(first, SCHEMA), path, ["id"])
    untouched = files_of(path, 2021)
    got = st.upsert_into_table(spark, spark.createDataFrame([(1, day(2024), 1.5), (3, day(2023), 3.5), (None, day(2023), 8.0)], SCHEMA), path, ["id"])
    assert sorted(((r.id or 0), r.date, r.v) for r in got.collect()) == [
        (0, day(2023), 8.0), (1, day(2024), 1.5), (2, day(2023, 6, 1), 2.0), (3, day(2023), 3.5), (4, day(2021), 4.0)]
    # 2022 lost its last row, 2021 was not rewritten
    assert sorted(os.path.basename(b) for b in glob.glob(f"{path}/bucket=*")) == ["bucket=2021", "bucket=2023", "bucket=2024"]
    assert files_of(path, 2021) == untouched
    back = st.upsert_into_table(spark, spark.createDataFrame([(1, day(2023), 7.0)], SCHEMA), path, ["id"])
    assert (1, day(2023), 7.0) in {(r.id, r.date, r.v) for r in back.collect()} and not glob.glob(f"{path}/bucket=2024")


def test_many_rounds_keep_one_row_a_key(spark, tmpdir_path):
    rng, path, want = random.Random(3), f"{tmpdir_path}/t", {}
    for number in range(5):
        batch = {k: (rng.choice([None, *(day(2019 + y) for y in range(4))]), float(number)) for k in rng.sample(range(40), 15)}
        want |= batch
        df = spark.createDataFrame([(k, d, v) for k, (d, v) in batch.items()], SCHEMA)
        got = st.upsert_into_table(spark, df, path, ["id"], bucket_mode="month")
        assert {r.id: (r.date, r.v) for r in got.collect()} == want and got.count() == len(want)


def test_a_table_without_an_index_gets_one(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    st.write_bucketed(spark.createDataFrame([(1, day(2022), 1.0), (2, day(2022), 2.0)], SCHEMA), path)
    got = st.upsert_into_table(spark, spark.createDataFrame([(1, day(2024), 5.0)], SCHEMA), path, ["id"])
    assert rows_of(got) == [(1, day(2024), 5.0), (2, day(2022), 2.0)]


@pytest.mark.parametrize("moved", [False, True])
def test_a_write_that_was_cut_off(spark, tmpdir_path, monkeypatch, moved):
    """After READY the next write finishes it, wherever it stopped; before, it is thrown away."""
    path = f"{tmpdir_path}/t"
    st.upsert_into_table(spark, spark.createDataFrame([(1, day(2022), 1.0), (2, day(2023), 2.0)], SCHEMA), path, ["id"])
    calls = []

    def stops(spark, source, target):
        if moved and not calls:
            calls.append(1)
            return move_folder(spark, source, target)
        raise RuntimeError("lost")
    monkeypatch.setattr(st, "move_folder", stops)
    with pytest.raises(RuntimeError):
        st.upsert_into_table(spark, spark.createDataFrame([(1, day(2024), 1.5), (2, day(2025), 2.5)], SCHEMA), path, ["id"])
    monkeypatch.undo()
    got = st.upsert_into_table(spark, spark.createDataFrame([(3, day(2024), 3.0)], SCHEMA), path, ["id"])
    assert rows_of(got) == [(1, day(2024), 1.5), (2, day(2025), 2.5), (3, day(2024), 3.0)]
    assert os.listdir(f"{path}/_staging") == []
    again = st.upsert_into_table(spark, spark.createDataFrame([(1, day(2020), 0.5)], SCHEMA), path, ["id"])
    assert rows_of(again)[0] == (1, day(2020), 0.5) and again.count() == 3
    shutil.copytree(f"{path}/bucket=2025", f"{path}/_staging/9-0-x/rows/bucket=2030")  # never ready
    st.finish_staged(spark, path, ["id"])
    assert not glob.glob(f"{path}/bucket=2030") and os.listdir(f"{path}/_staging") == []


def test_frequency_spellings_at_the_sink(spark):
    df = spark.createDataFrame([(1, day(2024), 1.0)], SCHEMA)
    got = {f: st.with_bucket(df, "year", f).first().bucket for f in ("D", "d", "1D", " Daily ", "day", "ME", "W", None)}
    assert got == {"D": "2024", "d": "2024", "1D": "2024", " Daily ": "2024", "day": "2024", "ME": "ALL", "W": "ALL", None: "ALL"}


LOG_SCHEMA = "path string, status string, date string"


def log_rows(spark, *rows):
    return spark.createDataFrame(list(rows), LOG_SCHEMA)


def test_keyed_log(spark, tmpdir_path):
    path = f"{tmpdir_path}/state"
    log = KeyedLog(spark, path, ["path"], LOG_SCHEMA, keep_non_null=["date"])
    read = lambda: {r.path: (r.status, r.date) for r in log.read().collect()}
    assert not log.exists() and read() == {} and log.next_generation() == 0
    log.append(log_rows(spark, *[(f"p{i}", "failed", f"d{i}") for i in range(100)]))
    number = log.append(log_rows(spark, ("p1", "success", None), ("q", "success", None)))
    assert number == 1 and os.listdir(f"{path}/_log") != []
    assert spark.read.parquet(path).count() == 100  # two rows are no reason to rewrite a hundred
    assert read()["p1"] == ("success", "d1") and read()["q"] == ("success", None) and len(read()) == 101
    log.append(log_rows(spark, ("p1", "again", "x")), number)  # the same round again replaces its rows
    assert read()["p1"] == ("again", "x") and "q" not in read()
    for i in range(12):
        log.append(log_rows(spark, (f"n{i}", "success", None)))
    assert spark.read.parquet(path).count() > 100 and len(read()) == 112  # merged
    log.append(log_rows(spark, ("p1", "old", "old")), 1)  # merged long ago: nothing changes
    assert read()["p1"] == ("again", "x")


def test_keyed_log_survives_a_cut(spark, tmpdir_path):
    path = f"{tmpdir_path}/state"
    log = KeyedLog(spark, path, ["path"], LOG_SCHEMA)
    log.append(log_rows(spark, ("a", "1", None), ("b", "1", None)))
    os.makedirs(f"{path}/_log/gen-000000000001")  # a generation without its mark does not count
    assert log.read().count() == 2 and log.next_generation() == 1
    shutil.move(path, f"{path}.next")  # cut between the removal of the old base and the move of the new one
    assert log.read().count() == 2
    log.append(log_rows(spark, ("a", "2", None)))
    assert {r.path: r.status for r in log.read().collect()} == {"a": "2", "b": "1"} and not os.path.exists(f"{path}.next")


def monthly(spark, rows):
    """One landed record per (file, title) with its rows."""
    import json
    out = [("m", f, json.dumps({"title": "月報", "fields": ["日期", "客戶代號", "金額"], "data": [list(map(str, r)) for r in data],
                                "crawlerdic": {"payload": {"date": "20240131"}}})) for f, data in rows]
    return spark.createDataFrame(out, "item string, source_file string, json string")


def monthly_args():
    from marketlake.operators.ingest import TableSpec
    return [("m", "ME", "1992-01-01", ["月報"], "M")], {"月報": TableSpec(item="m", subitem="月報", float_cols=["金額"], rename={"日期": "date", "客戶代號": "代號"})}


def test_late_monthly_rows_and_the_ledger(spark, tmpdir_path):
    table = f"{tmpdir_path}/t/m/月報"
    run = clean_batch_writer(f"{tmpdir_path}/t", *monthly_args(), stream="s1")
    read = lambda: {(str(r.date), r["代號"]): r["金額"] for r in spark.read.parquet(table).collect()}
    run(monthly(spark, [("f1", [("113/01/15", "a", 1), ("113/01/31", "a", 2), ("113/01/31", "b", 3)])]), 0)
    assert read() == {("2024-01-31", "a"): 2.0, ("2024-01-31", "b"): 3.0}
    run(monthly(spark, [("f2", [("113/01/31", "a", 9), ("113/01/31", "c", 4)])]), 1)
    assert read() == {("2024-01-31", "a"): 2.0, ("2024-01-31", "b"): 3.0, ("2024-01-31", "c"): 4.0}
    backfill = clean_batch_writer(f"{tmpdir_path}/t", *monthly_args(), update_old_non_daily=True, stream="s2")
    backfill(monthly(spark, [("f3", [("113/01/15", "a", 5), ("113/01/31", "a", 7)])]), 0)
    want = {("2024-01-15", "a"): 5.0, ("2024-01-31", "a"): 7.0, ("2024-01-31", "b"): 3.0, ("2024-01-31", "c"): 4.0}
    assert read() == want
    run(monthly(spark, [("f1", [("113/01/15", "a", 1), ("113/02/29", "z", 2)])]), 0)  # the batch comes again after the other stream's
    assert read() == want
    ledger = {(r.stream, r.batch): (r.policy, r.n_rows, r.n_late, r.n_stored) for r in st.batch_ledger(spark, table).read().collect()}
    assert ledger == {("s1", 0): ("insert", 2, 0, 2), ("s1", 1): ("insert", 2, 1, 1), ("s2", 0): ("upsert", 2, 1, 2)}


def test_two_streams_keep_their_quarantines(spark, tmpdir_path):
    broken = lambda name: spark.createDataFrame([("m", name, "{broken")], "item string, source_file string, json string")
    ids = []
    for k in "ab":
        broken(f"bad-{k}").write.parquet(f"{tmpdir_path}/land-{k}")
        args = f"{tmpdir_path}/land-{k}", f"{tmpdir_path}/t", f"{tmpdir_path}/ckpt-{k}"
        start_ingest_stream(spark, *args, *monthly_args()).awaitTermination()
        ids.append(stream_id(args[2]))
    got = {r.batch: r.source_file for r in spark.read.parquet(f"{tmpdir_path}/t/quarantine").collect()}
    assert got == {f"stream-{ids[0]}-0": "bad-a", f"stream-{ids[1]}-0": "bad-b"}


def test_a_round_cut_off_before_its_state(spark, tmpdir_path, monkeypatch):
    """Data and quarantine are stored, the state is not: the next run does the round again, without doubles."""
    import json
    from marketlake import catalog
    src, out, state = f"{tmpdir_path}/source", f"{tmpdir_path}/cleaned", f"{tmpdir_path}/state"
    os.makedirs(f"{src}/quotes")
    doc = {"title": "Quotes", "fields": ["證券代號", "收盤價"], "data": [["0050", "1"]], "crawlerdic": {"payload": {"date": "20240102"}}}
    for name, text in (("quotes_1", json.dumps(doc)), ("quotes_2", "{broken")):
        with open(f"{src}/quotes/{name}.json", "w") as fh:
            fh.write(text)
    cat = catalog.catalogue_frame(spark, [("quotes", "D", "2024-01-01", ["Quotes"], "Q")])
    append = KeyedLog.append

    def lost(self, rows, generation=None):
        if self.path == state:
            raise RuntimeError("lost")
        return append(self, rows, generation)
    monkeypatch.setattr(KeyedLog, "append", lost)
    with pytest.raises(RuntimeError):
        run_clean_job(spark, src, out, state, catalogue=cat, strict=False)
    monkeypatch.undo()
    assert run_clean_job(spark, src, out, state, catalogue=cat, strict=False) == {"files": 2, "tables": 1, "errors": 1}
    assert spark.read.parquet(f"{out}/quotes/Quotes").count() == 1 and spark.read.parquet(f"{out}/quarantine").count() == 1
    assert {r.file: r.status for r in st.job_state_log(spark, state).read().collect()} == {"quotes_1.json": "success", "quotes_2.json": "failed"}


def test_monthly_documents_overlap(spark):
    base = "/root/testdata/sf0.001"
    assert len(fx.MONTHLY_ROUNDS) == 3 and fx.monthly_documents(spark, base, 1).count() > 0
    assert "st2_stream_late_monthly" in q_extras.__dict__


def test_a_key_moves_in_a_stream(spark, tmpdir_path):
    import json
    from marketlake.operators.ingest import TableSpec
    spec = {"Quotes": TableSpec(item="q", subitem="Quotes", float_cols=["v"], pk=["代號"])}
    args = f"{tmpdir_path}/land", f"{tmpdir_path}/t", f"{tmpdir_path}/ckpt", [("q", "daily", "2020-01-01", ["Quotes"], "Q")], spec
    for name, date, rows in (("f1", "20231231", [["a", "1"], ["b", "2"]]), ("f2", "20240101", [["a", "3"]]), ("f3", "20240102", [["b", "4"]])):
        doc = {"title": "Quotes", "fields": ["證券代號", "v"], "data": rows, "crawlerdic": {"payload": {"date": date}}}
        spark.createDataFrame([("q", name, json.dumps(doc))], "item string, source_file string, json string").write.mode("append").parquet(args[0])
        start_ingest_stream(spark, *args).awaitTermination()
        if name == "f2":
            assert sorted(os.path.basename(b) for b in glob.glob(f"{args[1]}/q/Quotes/bucket=*")) == ["bucket=2023", "bucket=2024"]
    t = spark.read.parquet(f"{args[1]}/q/Quotes")
    assert sorted((r["代號"], str(r.date), r.v) for r in t.collect()) == [("a", "2024-01-01", 3.0), ("b", "2024-01-02", 4.0)]
    assert [os.path.basename(b) for b in glob.glob(f"{args[1]}/q/Quotes/bucket=*")] == ["bucket=2024"]
