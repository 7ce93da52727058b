import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import calendar as cal
from marketlake.operators import drivers as drv
from marketlake.sources.pages import parse_listing

D = dt.date


def test_scaffold_month_end_and_extend(spark):
    ex = catalog.expected_items(catalog.catalogue_frame(spark, [("d", "D", "2024-01-30", ["x"], "A"),
                                                                 ("m", "ME", "2023-12-15", ["y"], "B"),
                                                                 ("bad", "D", "nope", [], "C")]))
    cells = cal.scaffold(ex, "2024-02-01")
    got = sorted((r.item, r.date) for r in cells.collect())
    assert got == [("d", D(2024, 1, 30)), ("d", D(2024, 1, 31)), ("d", D(2024, 2, 1)),
                   ("m", D(2023, 12, 31)), ("m", D(2024, 1, 31))]
    old = cells.where(F.col("date") <= D(2024, 1, 30))
    ext = cal.extend_scaffold(old, ex, "2024-02-01")
    assert sorted((r.item, r.date) for r in ext.collect()) == got
    marked = cal.mark_present(cells, spark.createDataFrame([(D(2024, 1, 31), "d")], "date date, item string"))
    assert cal.work_queue(marked).count() == 4
    wide = cal.to_wide(marked, ["d", "m"])
    assert cal.to_long(wide, items=["d", "m"]).count() == 5


def test_labels(spark):
    log = spark.createDataFrame([("2024-01-02", "a", "wait"), ("2024/01/03", "a", "succeed"), ("bad", "b", "wait"),
                                 ("2024-02-30", "a", "wait")], "label string, item string, status string")
    inv = {r.label: (r.matches_ymd, r.valid_date, r.wait_cols) for r in cal.list_invalid_labels(log).collect()}
    assert inv == {"2024/01/03": (False, False, ""), "bad": (False, False, "b"), "2024-02-30": (True, False, "a")}
    # not valid text of the form first, then the rest (T4)
    assert [r.label for r in cal.list_invalid_labels(log).collect()] == ["2024/01/03", "bad", "2024-02-30"]
    again = log.unionByName(log.where("label = 'bad'"))
    a = cal.key_audit(again).collect()[0]
    assert (a.total, a.bad_count, a.duplicate_count, a.n_key_collisions) == (5, 3, 2, 0)
    assert {r.label for r in cal.key_problems(again).where("bad").collect()} == {"2024-02-30", "bad"}
    assert [r.label for r in cal.key_problems(again).where("duplicated").collect()] == ["bad"]
    with pytest.raises(KeyError):
        cal.rename_label(log, "nan", "2024-01-05")     # two unparsable labels
    one = cal.rename_label(log.where("label != 'bad'"), "nan", "2024-01-05")
    assert sorted(r.label for r in one.collect()) == ["2024-01-02", "2024-01-05", "2024/01/03"]
    assert cal.delete_bad_labels(log).count() == 2
    renamed = cal.rename_label(log, "bad", "2024-01-05")
    assert sorted(r.label for r in renamed.collect()) == ["2024-01-02", "2024-01-05", "2024-02-30", "2024/01/03"]
    with pytest.raises(ValueError):
        cal.rename_label(log, "bad", "2024/01/05")
    with pytest.raises(KeyError):
        cal.rename_label(log, "bad", "2024-01-02")
    with pytest.raises(KeyError):
        cal.rename_label(log, "missing", "2024-01-09")
    shown = cal.show_rows(log, ["2024-01-03"]).collect()
    assert [r.label for r in shown] == []          # neither raw nor key match
    assert [r.label for r in cal.show_rows(log, ["2024/01/03"]).collect()] == ["2024/01/03"]


def test_driver_tree(spark):
    rows = []
    for seg, reg, b, c in [("A", "X", 100, 200), ("A", "Y", 100, 100), ("B", "X", 50, 40), ("B", "Y", 50, 55)]:
        rows += [(2020, seg, reg, float(b)), (2021, seg, reg, float(c))]
    df = spark.createDataFrame(rows, "period int, seg string, reg string, amount double")
    t = drv.driver_tree(df, 2020, 2021, ["seg", "reg"], "amount", "period", max_depth=2, top_k=2,
                        min_node_share=0.05)
    nodes = {r.node_id: (r.depth, r.split_dim, r.delta) for r in t.nodes.collect()}
    assert nodes["root"] == (0, "seg", 95.0)
    assert nodes["seg=A"] == (1, "reg", 100.0)
    assert nodes["seg=A/reg=X"] == (2, None, 100.0)
    assert "seg=B" not in nodes or abs(nodes["seg=B"][2]) >= 0.05 * 95


def test_parse_listing():
    html = ("<table><tr><td>nav</td></tr></table><table><tr><td>h1</td><td> h2 </td></tr>"
            "<tr><td>a</td><td><b>b</b> c</td></tr><tr><td>short</td></tr></table>")
    assert parse_listing(html) == [["h1", "h2"], ["a", "bc"]]
    assert parse_listing("<p>no tables</p>") is None
