"""Event-time handling shared by batch and streaming operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY, _HOUR, _MINUTE, _SECOND = 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000


def is_wall_clock(df: DataFrame, ts_col: str) -> bool:
    return df.schema[ts_col].dataType.typeName() == "timestamp_ntz"


def _instant(wall: Column) -> Column:
    """The instant at which a UTC clock shows a wall-clock time, whatever the session's zone."""
    second = (F.date_part(F.lit("SECOND"), wall) * _SECOND).cast("long")
    micros = F.unix_date(wall.cast("date")).cast("long") * _DAY + F.hour(wall).cast("long") * _HOUR + F.minute(wall).cast("long") * _MINUTE + second
    return F.timestamp_micros(micros)


def _wall_clock(instant: Column) -> Column:
    """What a UTC clock shows at an instant, as TIMESTAMP_NTZ."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(_SECOND)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def to_micros(time: Column, kind) -> Column:
    """Microseconds since the epoch; a wall-clock time is read on a UTC clock."""
    return F.unix_micros(_instant(time) if kind.typeName() == "timestamp_ntz" else time)


def from_micros(micros: Column, kind) -> Column:
    """The time of type ``kind`` at which :func:`to_micros` gives ``micros``."""
    return _wall_clock(F.timestamp_micros(micros)) if kind.typeName() == "timestamp_ntz" else F.timestamp_micros(micros)


def event_time_for(df: DataFrame, ts_col: str, watermark: str | None) -> tuple[DataFrame, Column]:
    """Return (df, event-time column) ready for ``window``.

    Batch input is used as is (TIMESTAMP or TIMESTAMP_NTZ). A stream gets a
    watermark; since watermarks reject TIMESTAMP_NTZ, such a column is mapped
    to the instants of a UTC clock in a helper column, so that windows lie as
    they do in batch in every session zone (no day is short or long).
    ``bound_of`` maps window bounds back.
    """
    if not df.isStreaming or watermark is None:
        return df, F.col(ts_col)
    if is_wall_clock(df, ts_col):
        tmp = f"__{ts_col}_ts"
        df = df.withColumn(tmp, _instant(F.col(ts_col)))
        return df.withWatermark(tmp, watermark), F.col(tmp)
    return df.withWatermark(ts_col, watermark), F.col(ts_col)


def bound_of(bound: Column, df: DataFrame, ts_col: str, watermark: str | None) -> Column:
    """A window's bound in the type and clock of ``ts_col`` (of the ``df`` given to ``event_time_for``)."""
    return _wall_clock(bound) if df.isStreaming and watermark is not None and is_wall_clock(df, ts_col) else bound
