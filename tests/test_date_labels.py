"""Keys of date labels against pandas' own reading of a single label."""

import datetime as dt
import random
import warnings

import pandas as pd
from pyspark.sql import functions as F

from marketlake.functions import scalars as S

LABELS = """2024-01-05|2024/01/05|20240105|2024-1-5|2024.1.5|2024-01-05 03:04:05|2024-01-05T03:04:05|2024-01-05T03:04:05Z
2024-01-05T23:04:05+08:00|2024-1-5 03:04|2024-01-05 3:04 PM|2024-01-05 25:00|2024-01-05 13:04 PM|05.01.2024|13.01.2024|13/01/2024
1/5/2024|31-12-2024|Jan 5, 2024|5 Jan 2024|05-Jan-2024|Jan-05-2024|2024-Jan-05|2024 Jan 5|Fri, Jan 5, 2024|Mon Jan 5 2024
Jan 5th, 2024|5th of January 2024|2024|2024-01|Jan 2024|2024 January|01/05/24|24-01-05|13/01/24|2024-13-05|2024-02-30|2024-00-10
30/02/2024|13/13/2024|2024年1月5日|113/01/05|not a date|5|1234567|202401|240105|20240105 030405|20240105T030405|2024-001|2024-W01
5.1.24|JAN 5 2024|jan. 5, 2024|sept 5 2024|2024-01-05 03:04:05.123456789|20241305|Jan 5|2024-01-05, 03:04|03:04 2024-01-05|1 Jan 24
Jan 32, 2024|99999-01-01|1600-01-05|2024-1-5T3:4|2024-01-05 03|2024-01-05 3PM|2024--01--05|2024, 01, 05|1/2024|13/2024||  |nan"""
FORMS = ["%Y%m%d", "%d.%m.%Y", "%m/%d/%Y", "%b %d, %Y", "%A, %d %b %Y", "%Y-%m-%dT%H:%M:%S", "%d-%b-%Y %I:%M %p", "%m-%d-%y",
         "%B %Y", "%Y-%m", "%d %b %y", "%Y-%m-%d %H:%M:%S.%f", "%H:%M %Y-%m-%d", "%d/%m/%Y %H:%M", "%Y-%m-%dT%H:%M:%SZ"]


def test_keys_equal_those_of_pandas(spark):
    rng = random.Random(4)
    labels = [x for line in LABELS.split("\n") for x in line.split("|")]
    labels += [(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=rng.randrange(3 * 10 ** 9))).strftime(f) for f in FORMS for _ in range(20)]
    got = spark.createDataFrame(list(enumerate(labels)), "i int, label string").select("i", S.normalize_key("label")).collect()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [pd.to_datetime([x], errors="coerce")[0] for x in labels]
    assert {labels[i]: key for i, key in got} == {x: None if pd.isna(t) else t.strftime("%Y-%m-%d") for x, t in zip(labels, want)}


def test_labels_of_the_clock_name_no_day(spark):
    df = spark.createDataFrame([("now",), ("today",), ("03:04",), (None,)], "label string")
    assert [r[0] for r in df.select(S.normalize_key(F.col("label"))).collect()] == [None] * 4
