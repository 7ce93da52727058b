import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import signals as sig

D = dt.date


def panel(spark, rows):
    return spark.createDataFrame(rows, "code string, date date, value double")


def test_diff_zero_and_null_denominator(spark):
    p = panel(spark, [("a", D(2024, 1, 1), 0.0), ("a", D(2024, 1, 2), 5.0), ("a", D(2024, 1, 3), None),
                      ("a", D(2024, 1, 4), 2.0), ("b", D(2024, 1, 2), 4.0), (None, D(2024, 1, 2), 1.0)])
    out = {(r.code, r.date): r for r in sig.diff_previous(p, ["value", "missing"]).collect()}
    a2 = out[("a", D(2024, 1, 2))]
    assert a2.previous_value == 0.0 and a2.diff_value == 5.0 and a2.diff_percent_value is None
    assert out[("a", D(2024, 1, 4))].previous_value is None
    assert out[("b", D(2024, 1, 2))].previous_value is None
    assert out[(None, D(2024, 1, 2))].previous_value is None
    assert "previous_missing" not in sig.diff_previous(p, ["value", "missing"]).columns


def test_slice_before_lag(spark):
    p = panel(spark, [("a", D(2024, 1, d), float(d)) for d in range(1, 6)])
    out = sig.diff_for_entities(p, ["value"], "2024-01-03", "2024-01-05").orderBy("date").collect()
    assert [r.previous_value for r in out] == [None, 3.0, 4.0]


def test_signal_modes(spark):
    p = panel(spark, [("a", D(2024, 1, 1), 2.0), ("a", D(2024, 1, 2), 3.0)])
    assert [r.value for r in sig.build_signal(p, "value", "diff_percent").orderBy("date").collect()] == [None, 0.5]
    with pytest.raises(ValueError):
        sig.build_signal(p, "value", "nope")
    with pytest.raises(KeyError):
        sig.build_signal(p, "nope", "raw")


def test_cumulative_outcomes(spark):
    rows = [("a", D(2024, 1, d), v) for d, v in [(1, 1.0), (2, None), (3, 2.0), (4, 3.0), (5, None)]]
    p = panel(spark, rows)
    ents = spark.createDataFrame([("a",), ("z",)], "code string")

    def run(**kw):
        return {r.code: (r.stop_date, r.cumulative, r.reason)
                for r in sig.cumulative_to_threshold(p, "value", entities=ents, **kw).collect()}
    r = run(start_date="2024-01-01", threshold=3.0)
    assert r["a"] == (D(2024, 1, 3), 3.0, "threshold") and r["z"] == (None, 0.0, "exhausted")
    # not reached, no end -> last row of the data (a NULL row still counts as last)
    assert run(start_date="2024-01-01", threshold=100.0)["a"] == (D(2024, 1, 5), 6.0, "exhausted")
    # not reached, end given -> end_date
    assert run(start_date="2024-01-01", threshold=100.0, end_date="2024-01-03")["a"] == (D(2024, 1, 3), 3.0, "end_date")
    # end only
    assert run(start_date="2024-01-02", end_date="2024-01-04")["a"] == (D(2024, 1, 4), 5.0, "end_date")
    # backward
    assert run(start_date="2024-01-04", threshold=5.0, direction="backward")["a"] == (D(2024, 1, 3), 5.0, "threshold")
    assert run(start_date="2024-01-04", threshold=50.0, end_date="2024-01-02",
               direction="backward")["a"] == (D(2024, 1, 2), 5.0, "end_date")
    # empty range
    assert run(start_date="2025-01-01", threshold=1.0)["a"] == (None, 0.0, "exhausted")
    with pytest.raises(ValueError):
        sig.cumulative_to_threshold(p, "value", "2024-01-01")
    with pytest.raises(ValueError):
        sig.cumulative_to_threshold(p, "value", "2024-01-01", 1.0, direction="sideways")


def test_match_reference(spark):
    p = panel(spark, [("a", D(2024, 1, d), 1.0) for d in range(1, 11)])
    r = sig.match_reference_period(p, "value", "2024-01-01", "2024-01-03").collect()[0]
    # reference sum 3 from 2024-01-03 inclusive -> 01-03, 01-04, 01-05
    assert (r.stop_date, r.cumulative, r.reason, r.reference_sum) == (D(2024, 1, 5), 3.0, "threshold", 3.0)
    with pytest.raises(ValueError):
        sig.reference_sum(p, "value", "2030-01-01", "2030-01-02", strict=True)


def test_alignment_drops_all_null(spark):
    p = panel(spark, [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 2.0), ("b", D(2024, 1, 2), 5.0),
                      ("b", D(2024, 1, 3), 6.0)])
    out = sig.align_pair(p, "a", "b", "value", "diff").orderBy("date").collect()
    assert [(r.date, r.a_value, r.b_value) for r in out] == [(D(2024, 1, 2), 1.0, None), (D(2024, 1, 3), None, 1.0)]
    wide = sig.align_entities_wide(p, ["a", "b"], "value", "raw").orderBy("date").collect()
    assert len(wide) == 3 and wide[1]["a"] == 2.0 and wide[1]["b"] == 5.0


def test_cumulative_keeps_the_scale_of_decimals(spark):
    import datetime as dt
    from decimal import Decimal
    from marketlake.operators import signals as sg
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), Decimal("0.0040")) for d in (1, 2)],
                               "code string, date date, value decimal(10,4)")
    out = sg.cumulative_to_threshold(df, value_col="value", threshold=0.008, start_date=dt.date(2024, 1, 1)).collect()
    assert "0.008" in str(out) and "exhausted" not in str(out)
