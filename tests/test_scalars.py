import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions import scalars as S


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_minguo(spark):
    got = one(spark, S.minguo_to_iso_text(F.col("s")), [("110/06/01",), ("113/12/05",), ("2024-01-01",),
                                                         ("1/2",), (None,)], "s string")
    assert got == ["2021-06-01", "2024-12-05", "2024-01-01", "1/2", None]
    # calendar validity is not checked by the text form; the DATE form is
    assert one(spark, S.minguo_to_date(F.col("s")), [("113/02/30",)], "s string") == [None]


def test_parse_number(spark):
    got = one(spark, S.parse_number(F.col("s")), [("1,234.50",), ("--",), ("",), (" 12 ",), (None,)], "s string")
    assert got == [1234.5, None, None, 12.0, None]
    ints = one(spark, S.parse_number(F.col("s"), "bigint"), [("1,234",), ("1.5",), ("7.0",)], "s string")
    assert ints == [1234, None, 7]


def test_days_lag_floor_and_status(spark):
    rows = [(dt.datetime(2024, 1, 10, 10, 0),), (dt.datetime(2024, 1, 9, 10, 0),), (dt.datetime(2024, 1, 3),),
            (dt.datetime(2023, 12, 1),), (None,)]
    lag = one(spark, S.days_lag(F.col("t"), "2024-01-10"), rows, "t timestamp")
    assert lag == [-1, 0, 7, 40, None]
    st = one(spark, S.status_by_lag(S.days_lag(F.col("t"), "2024-01-10")), rows, "t timestamp")
    assert st == ["OK", "OK", "STALE", "STALE", "STALE"]
    assert one(spark, S.status_by_lag(F.col("n")), [(1,), (2,), (5,), (6,)], "n int") == ["OK", "LAGGING", "LAGGING", "STALE"]


def test_classify_and_outcome(spark):
    rows = [(503, None), (404, None), (403, None), (429, None), (None, "Timeout"), (None, "ConnectionError"),
            (None, "JSONDecodeError"), (None, "ValueError"), (200, None)]
    got = one(spark, S.classify_error(F.col("c"), F.col("e")), rows, "c int, e string")
    assert got == ["http_5xx", "http_404", "http_403", "http_4xx_other", "timeout", "connection_error",
                   "json_decode_error", "unknown", "unknown"]
    out = one(spark, S.response_outcome(F.col("c"), F.col("s"), F.col("e")),
              [(200, "OK", None), (200, "NO", None), (500, None, None), (None, None, "Timeout")],
              "c int, s string, e string")
    assert out == ["succeed", "close", "result error", "request error"]


def test_keys(spark):
    rows = [("2024-01-02",), ("2024/01/03",), ("20240104",), ("2024-1-5",), ("2024-02-30",), ("nan",), ("",), (None,)]
    assert one(spark, S.normalize_key(F.col("s")), rows, "s string") == [
        "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", None, None, None, None]
    assert one(spark, S.is_valid_key(F.col("s")), rows, "s string") == [True, False, False, False, False, False,
                                                                         False, False]
    assert one(spark, S.is_nan_like(F.col("s")), rows, "s string") == [False] * 5 + [True] * 3


def test_nfkc_bucket_fingerprint_first(spark):
    assert one(spark, S.nfkc(F.col("s")), [("ＡＢＣ１",), ("　x",)], "s string") == ["ABC1", " x"]
    d = [(dt.date(2024, 5, 17),)]
    assert [one(spark, S.bucket_key(F.col("d"), m), d, "d date")[0] for m in S.BUCKET_MODES] == [
        "2024", "2024Q2", "2024-05", "2024-05-17", "ALL"]
    fp = one(spark, S.file_fingerprint(F.col("n"), F.col("t")), [(12, dt.datetime(1970, 1, 1, 0, 0, 5, 900000))],
             "n bigint, t timestamp")
    assert fp == ["12-5"]
    assert one(spark, S.first_nonblank(F.col("a"), F.col("b"), default="unknown"),
               [("", "x"), (None, ""), ("y", "z")], "a string, b string") == ["x", "unknown", "y"]
    assert one(spark, S.apply_sign(F.col("v"), F.col("s")), [(1.5, " - "), (2.0, "+"), (3.0, None)],
               "v double, s string") == [-1.5, 2.0, 3.0]
    assert one(spark, S.slice_code(F.col("i"), 5, 9), [("TW0001234567",)], "i string") == ["1234"]
