"""Scalar column functions (math, date, geo).  All are Column -> Column
expressions built from Spark built-ins, so they stay inside whole-stage
codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio_in_range(num, den, lo: float = 0.0, hi: float = 1.0) -> Column:
    """num / den, NULL when den is 0 or when the ratio is outside [lo, hi]."""
    r = F.try_divide(_c(num), _c(den))
    return F.when(r.between(lo, hi), r)


def log_transform(x) -> Column:
    """natural log (NULL for non-positive input)."""
    v = _c(x)
    return F.when(v > 0, F.log(v))


def exp_transform(x) -> Column:
    """inverse of log_transform."""
    return F.exp(_c(x))


def manhattan_distance(lng1, lat1, lng2, lat2) -> Column:
    """|dlng| + |dlat| in degrees."""
    return F.abs(_c(lng2) - _c(lng1)) + F.abs(_c(lat2) - _c(lat1))


def great_circle(lng1, lat1, lng2, lat2, raw: bool = False) -> Column:
    """central angle 2*atan2(sqrt(a), sqrt(1-a)) (no radius).

    Degrees are converted to radians; ``raw=True`` feeds the degree values
    to sin/cos unconverted, as one job did.
    """
    conv = (lambda c: c) if raw else F.radians
    p1, p2 = conv(_c(lat1)), conv(_c(lat2))
    dphi = conv(_c(lat2) - _c(lat1))
    dlmb = conv(_c(lng2) - _c(lng1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def day_diff(a, b) -> Column:
    """whole days between the date parts of a and b (NULL if either missing)."""
    return F.datediff(F.to_date(_c(a)), F.to_date(_c(b)))


def seconds_between(start, end) -> Column:
    """epoch(end) - epoch(start) in seconds."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def weekday_mon0(ts) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(ts))


def calendar_fields(ts, convention: str = "mon0") -> dict[str, Column]:
    """month, day, hour, minute, weekday under one of three conventions.

    ``mon0``: weekday Monday=0; ``mon1``: Monday=1 plus weekend flag for 6, 7.
    """
    t = _c(ts)
    out = {"month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t), "minute": F.minute(t)}
    if convention == "mon1":
        wd = F.weekday(t) + 1
        out["weekday"] = wd
        out["weekend"] = wd.isin(6, 7).cast("int")
    else:
        out["weekday"] = F.weekday(t)
    return out


def epoch_to_local(epoch) -> Column:
    """F8: epoch seconds to a timestamp in the session time zone."""
    return F.timestamp_seconds(_c(epoch))


def local_to_epoch(ts) -> Column:
    """F8: timestamp back to epoch seconds."""
    return F.unix_timestamp(_c(ts))


def age_at(birth, today) -> Column:
    """completed years at ``today``; NULL birth gives 0.

    year difference minus one when the birthday (month, day) is still ahead;
    correct for 29 February births (months_between/12 is not).
    """
    b, t = F.to_date(_c(birth)), F.to_date(_c(today))
    before = (F.month(t) * 100 + F.dayofmonth(t)) < (F.month(b) * 100 + F.dayofmonth(b))
    return F.coalesce(F.year(t) - F.year(b) - before.cast("int"), F.lit(0))


def net_revenue(cpc, bid, rate, share: float = 0.15) -> Column:
    """(cpc - bid) * rate * share."""
    return (_c(cpc) - _c(bid)) * _c(rate) * F.lit(share)


def ms_to_minutes(ms) -> Column:
    """milliseconds to minutes."""
    return _c(ms) / 1000.0 / 60.0


def bin_to_group(x, edges: list[float], labels: list) -> Column:
    """map a value to a label by ascending upper edges (x <= edge)."""
    expr = None
    for edge, lab in zip(edges, labels):
        cond = _c(x) <= edge
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1])) if len(labels) > len(edges) else expr


def value_map(x, mapping: dict) -> Column:
    """Q4: dictionary lookup as a literal map (NULL for unknown keys)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), _c(x)) if kv else F.lit(None)


def differs(a, b) -> Column:
    """1 when a and b differ; two missing values also count as different."""
    return F.coalesce(_c(a) != _c(b), F.lit(True)).cast("int")
