"""Time buckets: hour, day, week (starting on Sunday) and month, all in UTC."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import GRANULARITIES

# Relative ranges of the metric page: how far back, bucket size.
RANGE_PRESETS = {
    "24h": ("24 HOUR", "hour"),
    "7d": ("7 DAY", "hour"),
    "30d": ("30 DAY", "day"),
    "90d": ("90 DAY", "day"),
    "1y": ("1 YEAR", "day"),
}

EPOCH = datetime(1970, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _known(granularity: str) -> str:
    if granularity not in GRANULARITIES:
        raise ValueError(f"unknown granularity: {granularity}")
    return granularity


def interval(granularity: str) -> Column:
    return F.expr(f"INTERVAL 1 {_known(granularity).upper()}")


def period_start(ts, granularity: str) -> Column:
    ts = _col(ts)
    if _known(granularity) == "week":
        day = F.expr("INTERVAL 1 DAY")
        return F.date_trunc("week", ts + day) - day
    return F.date_trunc(granularity, ts)


def next_period(ts, granularity: str) -> Column:
    return period_start(ts, granularity) + interval(granularity)


def period_seconds(period, granularity: str) -> Column:
    """Length of the period that starts at ``period`` (months differ)."""
    period = _col(period)
    return F.unix_timestamp(period + interval(granularity)) - F.unix_timestamp(period)


def is_complete(period, latest, granularity: str) -> Column:
    """A period is complete once a block at or after its end exists."""
    return _col(latest) >= next_period(period, granularity)


def second_bucket(ts) -> Column:
    return F.date_trunc("second", _col(ts))


def epoch_seconds(ts) -> Column:
    return F.unix_timestamp(_col(ts))


def block_time(milliseconds, seconds) -> Column:
    """Millisecond time where present and positive, else the whole-second time."""
    ms = _col(milliseconds).cast("bigint")
    return F.timestamp_millis(F.when(ms > 0, ms).otherwise(_col(seconds).cast("bigint") * 1000))


def range_preset(name: str) -> tuple[str, str]:
    return RANGE_PRESETS[name]


# --- times on the driver: always UTC, whatever the zone of the driver's machine ---

_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def utc_lit(t: datetime) -> Column:
    """A naive UTC time as a timestamp literal."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def utc_text(c) -> Column:
    return F.date_format(_col(c), _TEXT)


def utc_time(text: str | None) -> datetime | None:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f") if text else None


# --- driver-side period arithmetic for watermarks -------------------------------


def floor_period(t: datetime, granularity: str) -> datetime:
    t = t.replace(minute=0, second=0, microsecond=0)
    if _known(granularity) == "hour":
        return t
    t = t.replace(hour=0)
    if granularity == "week":
        return t - timedelta(days=(t.weekday() + 1) % 7)
    return t.replace(day=1) if granularity == "month" else t


def following_period(t: datetime, granularity: str) -> datetime:
    t = floor_period(t, granularity)
    if granularity == "month":
        return t.replace(year=t.year + t.month // 12, month=t.month % 12 + 1)
    return t + {"hour": timedelta(hours=1), "day": timedelta(days=1), "week": timedelta(days=7)}[granularity]


def pending_range(last: datetime | None, latest: datetime, granularity: str) -> tuple[datetime, datetime] | None:
    """[first, end) of all complete periods after the watermark ``last``, or None."""
    first = following_period(last or EPOCH, granularity)
    end = floor_period(latest, granularity)
    return (first, end) if end > first else None


def pending_periods(state: DataFrame, granularity: str, last="last_period", latest="latest") -> DataFrame:
    """One row per complete period after each row's watermark (column ``period``)."""
    first = next_period(last, granularity)
    end = period_start(latest, granularity) - interval(granularity)
    return state.where(end >= first).withColumn("period", F.explode(F.sequence(first, end, interval(granularity))))
