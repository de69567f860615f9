"""Numeric, JSON and time functions as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FINITE = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
INTEGER = r"^[0-9]+$"


def is_finite(c: Column) -> Column:
    """A finite number and nothing else. A cast would take nan, inf and 1.5f too."""
    return F.coalesce(c.rlike(FINITE), F.lit(False))


def finite_double(c: Column) -> Column:
    return F.when(is_finite(c), F.expr("1") * c.try_cast("double"))


def digits_only(c: Column) -> Column:
    """An integer from digits, else null."""
    return F.when(F.coalesce(c.rlike(INTEGER), F.lit(False)), c.try_cast("int"))


def exact_round(places: int):
    """Pandas UDF: half to even on the exact binary value."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def rounded(s: pd.Series) -> pd.Series:
        import numpy as np

        x = s.to_numpy(dtype=float, na_value=np.nan)
        # decimal output is exact, arithmetic is not
        out = np.char.mod(f"%.{places}f", x).astype(float) if places >= 0 else np.array([v if v != v or abs(v) == np.inf else round(v, places) for v in x.tolist()], float)
        return pd.Series(out).where(~np.isnan(out), None)

    return rounded


def general(value: float) -> str:
    """A threshold in a label: 11.6 -> 11.6, 2.0 -> 2."""
    return f"{value:g}"


def ratio(a: Column, b: Column, floor: float = 1e-6) -> Column:
    return a / F.greatest(b, F.lit(floor))


def failed(duration_ratio: Column, low: float = 0.7, high: float = 1.4) -> Column:
    """A generation that came out far too short or too long; null without a ratio."""
    return ~duration_ratio.between(low, high)


def cents(a: Column, b: Column) -> Column:
    return 1200.0 * F.log2(b / a)


def root_mean_square(c: Column) -> Column:
    return F.sqrt(F.avg(c * c))


def safe_corr(a: Column, b: Column) -> Column:
    """Correlation, null where a side is constant (corr itself raises there)."""
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of numbers; null if one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0)))


def expected_chunks(seconds: Column, chunk: float = 300.0) -> Column:
    """Requests that an episode needs; halves are rounded to even."""
    return F.greatest(F.lit(1).cast("long"), F.bround(seconds / chunk).cast("long"))


def output_rate(rate: Column, target: int = 24_000) -> Column:
    """Never above the source's own rate."""
    return F.least(F.lit(target), rate)


def quality_tag(rate: Column, least: int = 22_050) -> Column:
    return F.when(rate >= least, "hifi").otherwise("lofi")


def metric_mean(block: Column, key: str) -> Column:
    """A metric of a JSON block: the mean of a statistics object, or the number itself."""
    whole = F.get_json_object(block, f"$.{key}")
    return F.coalesce(F.get_json_object(block, f"$.{key}.mean").try_cast("double"), whole.try_cast("double"))


def json_list(reply: Column) -> Column:
    """A reply's JSON list as array<string>, one element each; text around the list is ignored; anything else is empty."""
    inner = F.regexp_extract(reply, r"(?s)(\[.*\])", 1)
    first = F.when(F.json_array_length(reply).isNotNull(), reply)
    second = F.when(F.json_array_length(inner).isNotNull(), inner)
    return F.coalesce(F.from_json(F.coalesce(first, second), "array<string>"), F.array().cast("array<string>"))


def retry_delay(error: Column) -> Column:
    """Seconds that a quota error asks to wait (`"30s"`), null if it says nothing."""
    parsed = F.from_json(error, "error struct<details:array<struct<retryDelay:string,violations:array<struct<quotaId:string,quotaValue:string>>>>>")
    delays = F.filter(F.transform(parsed["error"]["details"], lambda d: d["retryDelay"]), lambda d: d.isNotNull())
    return F.rtrim(F.get(delays, F.lit(0)), F.lit("s")).try_cast("double")


def is_daily_quota(error: Column) -> Column:
    parsed = F.from_json(error, "error struct<details:array<struct<retryDelay:string,violations:array<struct<quotaId:string,quotaValue:string>>>>>")
    return F.coalesce(F.exists(parsed["error"]["details"], lambda d: F.coalesce(F.exists(d["violations"], lambda v: F.coalesce(v["quotaId"].contains("PerDay"), F.lit(False))), F.lit(False))), F.lit(False))


def next_reset(now_utc: Column, zone: str = "America/Los_Angeles") -> Column:
    """The next midnight of a zone, in UTC, from a UTC time."""
    local = F.from_utc_timestamp(now_utc, zone)
    return F.to_utc_timestamp(F.date_trunc("day", local) + F.expr("INTERVAL 1 DAY"), zone)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp")) / 1e6
