import json
import os

from marketlake import catalog
from marketlake.plans.clean_job import run_clean_job
from marketlake.operators import ingest as ig


def _doc(day, rows):
    return {"stat": "OK", "title": f"{day} Quotes", "fields": ["證券代號", "收盤價"], "data": rows,
            "crawlerdic": {"payload": {"date": day}}}


def test_incremental_clean_job(spark, tmpdir_path):
    """Rounds of at most batch_size files, idempotent re-runs, changed
    files re-processed, data written before the job state."""
    src, out, state = f"{tmpdir_path}/source", f"{tmpdir_path}/cleaned", f"{tmpdir_path}/state"
    os.makedirs(f"{src}/quotes")
    for day, rows in [("20240102", [["0050", "1,000.5"]]), ("20240103", [["0050", "2"], ["0051", "3"]]),
                      ("20240104", [["0050", "4"]])]:
        with open(f"{src}/quotes/quotes_{day}.json", "w") as fh:
            json.dump(_doc(day, rows), fh)
    cat = catalog.catalogue_frame(spark, [("quotes", "D", "2024-01-01", ["Quotes"], "Q")])
    specs = {"Quotes": ig.TableSpec(item="quotes", subitem="Quotes", float_cols=["收盤價"])}
    kw = dict(catalogue=cat, specs=specs, batch_size=2)
    r1 = run_clean_job(spark, src, out, state, **kw)
    r2 = run_clean_job(spark, src, out, state, **kw)
    r3 = run_clean_job(spark, src, out, state, **kw)
    assert (r1["files"], r2["files"], r3["files"]) == (2, 1, 0)
    t = spark.read.parquet(f"{out}/quotes/Quotes")
    assert t.count() == 4
    # a changed file is detected (size and mtime fingerprint) and upserted again
    with open(f"{src}/quotes/quotes_20240104.json", "w") as fh:
        json.dump(_doc("20240104", [["0050", "40.25"]]), fh)
    os.utime(f"{src}/quotes/quotes_20240104.json", (2_000_000_000, 2_000_000_000))
    r4 = run_clean_job(spark, src, out, state, **kw)
    assert r4["files"] == 1
    got = {(str(r.date), r["代號"]): r["收盤價"] for r in spark.read.parquet(f"{out}/quotes/Quotes").collect()}
    assert got[("2024-01-04", "0050")] == 40.25 and got[("2024-01-02", "0050")] == 1000.5 and len(got) == 4
    st = spark.read.parquet(state)
    assert st.where("status = 'success'").count() == 3


def test_errors_are_stored_and_files_marked_failed(spark, tmpdir_path):
    """Q4: without strict a broken file goes to quarantine, stays 'failed' and comes up again."""
    src, out, state = f"{tmpdir_path}/source", f"{tmpdir_path}/cleaned", f"{tmpdir_path}/state"
    os.makedirs(f"{src}/quotes")
    with open(f"{src}/quotes/quotes_20240102.json", "w") as fh:
        json.dump(_doc("20240102", [["0050", "1"]]), fh)
    with open(f"{src}/quotes/quotes_20240103.json", "w") as fh:
        fh.write("{broken")
    cat = catalog.catalogue_frame(spark, [("quotes", "D", "2024-01-01", ["Quotes"], "Q")])
    r = run_clean_job(spark, src, out, state, catalogue=cat, strict=False)
    assert r == {"files": 2, "tables": 1, "errors": 1}
    got = {x.file: x.status for x in spark.read.parquet(state).collect()}
    assert got == {"quotes_20240102.json": "success", "quotes_20240103.json": "failed"}
    q = spark.read.parquet(f"{out}/quarantine").collect()
    assert [x.error.message for x in q] == ["document is not an object"]
    assert run_clean_job(spark, src, out, state, catalogue=cat, strict=False)["files"] == 1
