"""Column functions: imputation, rounding, labels, scaling, clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def impute(c: Column, default=2) -> Column:
    """c with null and zero (for strings: null and empty) replaced by default."""
    none = F.lit("") if isinstance(default, str) else F.lit(0)
    return F.coalesce(F.nullif(c, none), F.lit(default))


def round2(c: Column) -> Column:
    """Two decimals, half away from zero, of the decimal and not of the binary value: 1.005 gives 1.01
    in every engine that takes the same way."""
    return F.round(c.cast("decimal(38,10)"), 2).cast("double")


def pct_change(new: Column, old: Column) -> Column:
    """Change in per cent; null where old is zero or null."""
    return F.try_divide(new - old, F.nullif(old, F.lit(0.0))) * 100


def classify(pct: Column, null_target: int | None = 5) -> Column:
    """Class 0 to 5 of a change in per cent, cut at -1, -0.5, 0, 0.5 and 1 (each inclusive below)."""
    out = F.when(pct.isNull(), F.lit(null_target).cast("int"))
    for k, cut in enumerate((-1.0, -0.5, 0.0, 0.5, 1.0)):
        out = out.when(pct <= cut, F.lit(k))
    return out.otherwise(F.lit(5))


def sigmoid(c: Column, scale: float) -> Column:
    """0 to 5, rounded: a logistic of the imputed value over its scale."""
    return round2(5 / (1 + F.exp(-5 * impute(c) / F.lit(float(scale)))))


def true_range(high: Column, low: Column, previous: Column) -> Column:
    """Largest of high - low and the distances to the previous close; nulls are skipped."""
    return F.greatest(high - low, F.abs(high - previous), F.abs(low - previous))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def market_hours(ts: Column, zone: str = "America/New_York") -> Column:
    """True on Monday to Friday from 09:30:00 to 16:00:00, both included, in the exchange's zone. ts is
    UTC; holidays aren't known."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))
    second = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    return (F.weekday(local) < 5) & second.between(9 * 3600 + 1800, 16 * 3600)


def epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c).cast("timestamp_ntz")


def epoch_ns(c: Column) -> Column:
    """Microseconds are what a timestamp can hold; keep the nanoseconds themselves beside it."""
    return F.timestamp_micros(F.floor(c / F.lit(1000).cast("decimal(20,0)")).cast("long")).cast("timestamp_ntz")


def parse_utc(c: Column, fallback: Column | None = None) -> Column:
    """ISO-8601 with or without Z; what is missing or can't be read becomes fallback (default: now)."""
    read = F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00")).cast("timestamp_ntz")
    return F.coalesce(read, fallback if fallback is not None else F.localtimestamp())


def concat_codes(ts: Column, seq: Column, codes: Column, where: Column | None = None) -> Column:
    """Aggregate: all code arrays of a group in order of (ts, seq), as one string of digits; of the rows `where` alone, if given."""
    one = F.struct(ts.alias("ts"), seq.alias("seq"), F.coalesce(codes, F.expr("cast(array() as array<int>)")).alias("codes"))
    ordered = F.array_sort(F.collect_list(one if where is None else F.when(where, one)))
    return F.array_join(F.transform(F.flatten(F.transform(ordered, lambda x: x["codes"])), lambda x: x.cast("string")), "")


def last_known(c: Column, ts: Column, seq: Column) -> Column:
    """Aggregate: the value at the latest (ts, seq) that has one."""
    return F.max_by(c, F.when(c.isNotNull(), F.struct(ts, seq)))
