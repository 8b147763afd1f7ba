"""Column helpers shared by the operators.  All of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(num, den) -> Column:
    """num / den as DOUBLE, 0 when the denominator is not positive."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def percent(num, den, digits: int = 2) -> Column:
    """100 * num / den rounded, 0 when the denominator is not positive."""
    num, den = as_col(num), as_col(den)
    share = num.cast("double") / den.cast("double") * 100.0
    return F.when(den > 0, F.round(share, digits)).otherwise(F.lit(0.0))


def change_pct(now, before) -> Column:
    """Relative change in percent, 0 when there is nothing to compare with."""
    now, before = as_col(now).cast("double"), as_col(before).cast("double")
    moved = (now - before) / before * 100.0
    return F.when(before.isNull() | (before == 0), F.lit(0.0)).otherwise(moved)


def money(col) -> Column:
    """Exact, order-independent money sum delivered as DOUBLE with two decimals."""
    return F.coalesce(F.sum(as_col(col).cast("decimal(18,2)")), F.lit(0)).cast("double")


def lookup(col, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Fixed small lookup as a literal map: no join, no shuffle."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.create_map(*pairs)[as_col(col)]
    return found if default is None else F.coalesce(found, default)


def pick(values: Sequence[str], index: Column) -> Column:
    """values[index mod n] from a fixed list."""
    items = F.array(*[F.lit(v) for v in values])
    return F.element_at(items, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def event_window(ts: str, length: str, slide: str | None = None) -> Column:
    return F.window(ts, length, slide) if slide else F.window(ts, length)


def window_keys(df: DataFrame, ts: str, length: str | None, slide: str | None = None):
    """Group keys for a window, or none when the whole input is one micro-window."""
    if length is None:
        return []
    return [event_window(ts, length, slide).alias("window")]


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by window_start and window_end."""
    if "window" not in df.columns:
        return df
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def seconds_of(length: str) -> int:
    """Length in seconds of a day-time duration such as '10 seconds' or '1 day'."""
    amount, unit = length.split()
    unit = unit.rstrip("s")
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(amount) * size)


def parse_instant(text) -> Column:
    """ISO-8601 text to a UTC wall-clock TIMESTAMP_NTZ, null when it does not parse.

    The guard refuses the partial forms Spark's cast takes ('2026', '22:14:03').
    Text without a zone is read as UTC, whatever the session zone is.
    """
    text = as_col(text)
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"[T ]")
    utc = F.when(zoned, text).otherwise(
        F.when(text.rlike("[T ]"), F.concat(text, F.lit("Z"))).otherwise(
            F.concat(text, F.lit("T00:00:00Z"))
        )
    )
    # '-0500' is valid ISO but the cast wants '-05:00'.
    utc = F.regexp_replace(utc, r"([+-]\d{2})(\d{2})$", "$1:$2")
    instant = F.when(iso, utc).try_cast("timestamp")
    return to_utc_ntz(instant)


def has_zone(text) -> Column:
    return as_col(text).rlike(r"^\d{4}-\d{2}-\d{2}[T ].*(Z|[+-]\d{2}:?\d{2})$")


def to_utc_ntz(instant: Column) -> Column:
    """Instant to UTC wall clock, independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH))


def micros(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), as_col(ts))


def fence(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that later filters read as values instead of being copied into.

    Catalyst pushes a filter below a projection by copying the projected expression into
    it, so a parse used by many checks would be planned (and run) many times over.  A
    generator is a boundary for that rule; a one-element explode costs one row copy.
    """
    keep = [c for c in df.columns if c not in cols]
    made = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))).alias("_f")
    return df.select(*keep, made).select(*keep, *[F.col("_f")[n].alias(n) for n in cols])
