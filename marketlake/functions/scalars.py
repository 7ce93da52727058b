"""Column -> Column scalar functions.

All of them are built-in Spark expressions and stay inside whole-stage
codegen; the only Python function here is NFKC normalisation, which Spark has
no built-in for; ``nfkc_strip_fast`` sends it only the values that it may change.
"""

from __future__ import annotations

import sys
import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .date_labels import date_of_label

# workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Freshness thresholds in days (OK <= 1, LAGGING <= 5, else STALE).
DEFAULT_OK_DAYS = 1
DEFAULT_WARN_DAYS = 5

# Labels used in status / relation / outcome columns.
STATUS_OK, STATUS_LAGGING, STATUS_STALE = "OK", "LAGGING", "STALE"
OUTCOME_SUCCEED, OUTCOME_CLOSE = "succeed", "close"
OUTCOME_RESULT_ERROR, OUTCOME_REQUEST_ERROR = "result error", "request error"
OUTCOME_WAIT = "wait"

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# N1 ----------------------------------------------------------------------
def replace_text(c, search: str, replacement: str = "") -> Column:
    return F.replace(_c(c), F.lit(search), F.lit(replacement))


# N2 ----------------------------------------------------------------------
def strip_ideographic_space(c) -> Column:
    """Remove every full-width space (U+3000)."""
    return F.translate(_c(c), "　", "")


# N3 ----------------------------------------------------------------------
def parse_number(c, target: str = "double") -> Column:
    """Tolerant numeric parse: thousands commas removed, unparsable -> NULL."""
    txt = F.replace(_c(c).cast("string"), F.lit(","), F.lit(""))
    if target in ("bigint", "long", "int", "integer"):
        # integers may arrive as "1,234.0": go through decimal so the value is kept exactly
        return F.when(txt.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"),
                      txt.try_cast("decimal(38,6)").try_cast(target))
    return txt.try_cast(target)


# N4 ----------------------------------------------------------------------
def minguo_to_iso_text(c) -> Column:
    """'yyy/mm/dd' (Minguo years) -> 'yyyy-mm-dd' text; other shapes unchanged.

    The calendar is not validated here (same as the text conversion it
    mirrors); use ``F.try_to_date`` on the result for a checked DATE.
    """
    raw = _c(c)
    parts = F.split(F.trim(raw), "/")
    y, m, d = (F.get(parts, i).try_cast("int") for i in range(3))
    ok = (F.size(parts) == 3) & y.isNotNull() & m.isNotNull() & d.isNotNull()
    return F.when(ok, F.format_string("%d-%02d-%02d", y + F.lit(1911), m, d)).otherwise(raw)


def minguo_to_date(c) -> Column:
    return F.try_to_date(minguo_to_iso_text(c), "yyyy-MM-dd")


# N5 ----------------------------------------------------------------------
def apply_sign(value, sign) -> Column:
    """'-' in the sign column negates the change; anything else keeps it."""
    v = _c(value)
    return F.when(F.trim(_c(sign).cast("string")) == "-", -v).otherwise(v)


# N6 ----------------------------------------------------------------------
def parse_date_tolerant(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(c).cast("string"), fmt)


# N7 ----------------------------------------------------------------------
BUCKET_MODES = ("year", "quarter", "month", "day", "all")


def bucket_key(date_col, mode: str = "year") -> Column:
    d = _c(date_col)
    mode = (mode or "all").lower()
    if mode == "year":
        return F.date_format(d, "yyyy")
    if mode == "quarter":
        return F.concat(F.date_format(d, "yyyy"), F.lit("Q"), F.quarter(d).cast("string"))
    if mode == "month":
        return F.date_format(d, "yyyy-MM")
    if mode == "day":
        return F.date_format(d, "yyyy-MM-dd")
    if mode == "all":
        return F.lit("ALL")
    raise ValueError(f"unknown bucket mode {mode!r}; expected one of {BUCKET_MODES}")


# N8 / N10 -----------------------------------------------------------------
def _micros(ts) -> Column:
    # unix_micros rejects TIMESTAMP_NTZ: cast to TIMESTAMP first (session zone is UTC)
    return F.unix_micros(_c(ts).cast("timestamp"))


def days_lag(mtime, today) -> Column:
    """floor((today 00:00 - mtime) / 1 day); a file touched later today gives -1."""
    today_ts = F.to_date(today if isinstance(today, Column) else F.lit(str(today))).cast("timestamp")
    return F.floor((F.unix_micros(today_ts) - _micros(mtime)) / F.lit(MICROS_PER_DAY)).cast("bigint")


def fractional_days(later, earlier) -> Column:
    return (_micros(later) - _micros(earlier)).cast("double") / F.lit(float(MICROS_PER_DAY))


# N9 ----------------------------------------------------------------------
def status_by_lag(lag, ok_days: int = DEFAULT_OK_DAYS, warn_days: int = DEFAULT_WARN_DAYS) -> Column:
    c = _c(lag)
    return (F.when(c.isNull(), F.lit(STATUS_STALE))
            .when(c <= ok_days, F.lit(STATUS_OK))
            .when(c <= warn_days, F.lit(STATUS_LAGGING))
            .otherwise(F.lit(STATUS_STALE)))


# N11 ---------------------------------------------------------------------
def slice_code(isin, start, stop) -> Column:
    """0-based [start, stop) slice of an ISIN, as in Python slicing."""
    s, e = _c(start) if not isinstance(start, int) else F.lit(start), _c(stop) if not isinstance(stop, int) else F.lit(stop)
    return F.substring(_c(isin), s + 1, e - s)


# N12 ---------------------------------------------------------------------
# Exception kinds recognised by the error classifier.
TIMEOUT_KINDS = ("Timeout", "ReadTimeout", "ConnectTimeout")
CONNECTION_KINDS = ("ConnectionError",)
JSON_KINDS = ("JSONDecodeError",)


def classify_error(status_code, exception_type) -> Column:
    s = _c(status_code).try_cast("int")
    e = _c(exception_type)
    return (F.when(s.between(500, 599), F.lit("http_5xx"))
            .when(s == 404, F.lit("http_404"))
            .when(s == 403, F.lit("http_403"))
            .when(s.between(400, 499), F.lit("http_4xx_other"))
            .when(e.isin(*TIMEOUT_KINDS), F.lit("timeout"))
            .when(e.isin(*CONNECTION_KINDS), F.lit("connection_error"))
            .when(e.isin(*JSON_KINDS), F.lit("json_decode_error"))
            .otherwise(F.lit("unknown")))


# N13 ---------------------------------------------------------------------
def response_outcome(status_code, stat, exception_type=None) -> Column:
    """exception -> request error; 200 & stat OK -> succeed; 200 -> close; else result error."""
    s = _c(status_code)
    out = (F.when((s == 200) & (F.coalesce(_c(stat), F.lit("")) == "OK"), F.lit(OUTCOME_SUCCEED))
           .when(s == 200, F.lit(OUTCOME_CLOSE))
           .otherwise(F.lit(OUTCOME_RESULT_ERROR)))
    if exception_type is not None:
        out = F.when(_c(exception_type).isNotNull(), F.lit(OUTCOME_REQUEST_ERROR)).otherwise(out)
    return out


# N14 ---------------------------------------------------------------------
def is_nan_like(c) -> Column:
    x = _c(c)
    return x.isNull() | F.lower(F.trim(x.cast("string"))).isin("", "nan", "nat")


def normalize_key(c) -> Column:
    """Parsable label -> 'YYYY-MM-DD', otherwise NULL (spellings: ``date_labels``)."""
    return F.date_format(date_of_label(_c(c)), "yyyy-MM-dd")


def matches_ymd(c) -> Column:
    return F.coalesce(_c(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def is_valid_key(c) -> Column:
    x = _c(c)
    return matches_ymd(x) & F.try_to_date(x, "yyyy-MM-dd").isNotNull()


# N15 ---------------------------------------------------------------------
@F.arrow_udf(T.StringType())
def nfkc(s: pa.Array) -> pa.Array:
    """Unicode NFKC normalisation (no Spark built-in); a batch of nulls only is passed on."""
    if s.null_count == len(s):
        return s
    return pa.array([None if v is None else unicodedata.normalize("NFKC", v) for v in s.to_pylist()], pa.string())


def nfkc_strip(c) -> Column:
    return F.trim(nfkc(_c(c)))


# Printable ASCII and CJK unified ideographs have no decomposition and never
# compose: NFKC leaves such text unchanged, so it needs no Python round trip.
NFKC_STABLE = r"^[\x20-\x7E\x{4E00}-\x{9FFF}]*$"


def nfkc_strip_fast(c) -> Column:
    """trim(NFKC(c)); only values outside the NFKC-stable range are sent to
    the Python UDF (the others pass it as NULL)."""
    x = _c(c)
    stable = x.rlike(NFKC_STABLE)
    return F.when(stable, F.trim(x)).otherwise(F.trim(nfkc(F.when(~stable, x))))


# N16 ---------------------------------------------------------------------
def file_fingerprint(size, mtime) -> Column:
    return F.concat_ws("-", _c(size).cast("bigint").cast("string"),
                       F.floor(F.unix_micros(_c(mtime).cast("timestamp")) / F.lit(1_000_000)).cast("string"))


# N17 ---------------------------------------------------------------------
def first_nonblank(*cols, default: str | None = None) -> Column:
    parts = [F.nullif(_c(c).cast("string"), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


# Field generations of an error record, newest first.
ERROR_REASON_FIELDS = ("error_reason", "err_type", "error_type", "errormessage3", "errormessage1")
ERROR_MESSAGE_FIELDS = ("error_message", "errormessage2")
