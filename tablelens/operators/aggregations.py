"""Facets, term counts and date histograms over whole tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.plans.scope import field_type


def _labelled(fields: Iterable[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}


def _tagged(df: DataFrame, label: str, field: str) -> tuple[Column | None, Column | None]:
    """The row's values of a field as ``(facet, key)``: one struct, or an array of distinct ones."""
    kind, col = field_type(df.schema, field), F.col(field)
    if kind is None:
        raise ValueError(f"no field {field}")

    def pair(value: Column) -> Column:
        return F.struct(F.lit(label).alias("facet"), value.cast("string").alias("key"))

    if isinstance(kind, T.ArrayType):
        return None, F.transform(F.array_distinct(col), pair)
    return pair(col), None


def facet_counts(df: DataFrame, fields) -> DataFrame:
    """Rows per ``(facet, key)`` for several fields in one scan."""
    tagged = [_tagged(df, label, field) for label, field in _labelled(fields).items()]
    single = [one for one, _ in tagged if one is not None]
    many = [array for _, array in tagged if array is not None]
    pairs = [F.array(*single)] if single else []
    pairs += [F.coalesce(array, F.array().cast("array<struct<facet:string,key:string>>")) for array in many]
    # The outer form: the inner one would first compute the whole array once more to test its size.
    rows = df.select(F.explode_outer(F.concat(*pairs) if len(pairs) > 1 else pairs[0]).alias("p"))
    counts = rows.select("p.facet", "p.key").filter(F.col("key").isNotNull())
    return counts.groupBy("facet", "key").agg(F.count("*").alias("count"))


def facets(df: DataFrame, fields, limit: int = 25) -> DataFrame:
    """The most frequent values of each field, what is left over, and a zero count error.

    The cut runs per task before the shuffle, so a facet with many values never meets in one task;
    the total per facet is a separate pre-aggregated sum over as many rows as there are facets.
    """
    counts = facet_counts(df, fields)
    totals = counts.groupBy("facet").agg(F.sum("count").alias("total"))
    by_facet = Window.partitionBy("facet")
    rank = F.row_number().over(by_facet.orderBy(F.desc("count"), F.asc("key")))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= limit)
    kept = top.withColumn("kept", F.sum("count").over(by_facet))
    return kept.join(F.broadcast(totals), "facet").select(
        "facet",
        "key",
        "count",
        F.lit(0).cast("long").alias("doc_count_error"),
        (F.col("total") - F.col("kept")).alias("other_count"),
    )


def approximate_facet(df: DataFrame, field: str, limit: int = 25, counters: int = 10_000) -> DataFrame:
    """Most frequent values from a bounded sketch: one small state per task, no shuffle by value."""
    one, many = _tagged(df, field, field)
    pairs = df.select((one if many is None else F.explode_outer(many)).alias("p"))
    values = pairs.select("p.key").filter(F.col("key").isNotNull())
    top = values.agg(F.expr(f"approx_top_k(key, {int(limit)}, {int(counters)})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("key"), F.col("t.count").alias("count"))


_ORDER_FIELDS = {"_count": "count", "_key": "key"}


def term_counts(
    df: DataFrame, field: str, limit: int = 10, exclude=(), order: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows per value of one field, ordered by count (default) or key."""
    counts = facet_counts(df, {field: field}).drop("facet")
    if exclude:
        counts = counts.filter(~F.col("key").isin([str(v) for v in exclude]))
    keys = []
    for name, direction in (order or {"_count": "desc"}).items():
        if name not in _ORDER_FIELDS:
            raise ValueError(f"order by _count or _key, not {name}")
        col = F.col(_ORDER_FIELDS[name])
        keys.append(col.desc() if direction.lower() == "desc" else col.asc())
    return counts.orderBy(*keys, F.col("key").asc()).limit(limit)


# Interval names, and for those cut from the written time the characters to keep.
INTERVALS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")
_KEPT = {"year": 4, "month": 7, "day": 10, "hour": 13, "minute": 16, "second": 19}


def offset_text(offset: int | str) -> str:
    """``120`` or ``'+02:00'`` as ``'+02:00'``; anything else is an error."""
    if isinstance(offset, int) and not isinstance(offset, bool):
        hours, minutes = divmod(abs(offset), 60)
        return f"{'-' if offset < 0 else '+'}{hours:02d}:{minutes:02d}"
    if isinstance(offset, str) and re.fullmatch(r"[+-]\d\d:\d\d", offset):
        return offset
    raise ValueError(f'an offset is a number of minutes or a string like "+02:00", not {offset!r}')


def _offset_minutes(offset: int | str) -> int:
    text = offset_text(offset)
    minutes = int(text[1:3]) * 60 + int(text[4:6])
    return -minutes if text[0] == "-" else minutes


def session_zone(df: DataFrame) -> str | None:
    """The session's time zone, None when it is UTC."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return None if zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00") else zone


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_of(instant: Column) -> Column:
    """An instant as zone-less UTC time, by its distance from the epoch."""
    seconds = F.unix_micros(instant).cast("decimal(24,6)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def instant_of(utc: Column) -> Column:
    """The inverse of :func:`utc_of`."""
    return F.timestamp_seconds((utc - F.expr(_EPOCH)).cast("interval second").cast("decimal(18,6)"))


def utc_time(df: DataFrame, field: str) -> Column:
    """A date field as zone-less UTC time; a zone-less field is taken as UTC already."""
    col = F.col(field)
    if session_zone(df) and isinstance(field_type(df.schema, field), T.TimestampType):
        return utc_of(col)
    return col.cast("timestamp_ntz")


def bucket_start(utc: Column, interval: str, offset: int | str = 0) -> Column:
    """Start of a bucket in local time of the offset; zone-less throughout, so no session zone matters."""
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval {interval}; use one of {', '.join(INTERVALS)}")
    minutes = _offset_minutes(offset)
    local = utc + F.expr(f"make_dt_interval(0, 0, {minutes}, 0)") if minutes else utc
    if interval in ("hour", "minute", "second"):
        written = F.substring(local.cast("string"), 1, _KEPT[interval])
        return F.concat(written, F.lit("0000-00-00 00:00:00"[_KEPT[interval] :])).cast("timestamp_ntz")
    day = local.cast("date")
    return (day if interval == "day" else F.trunc(day, interval)).cast("timestamp_ntz")


def bucket_key(start: Column, interval: str) -> Column:
    if interval == "week":
        year = F.extract(F.lit("YEAROFWEEK"), start)
        return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(F.weekofyear(start).cast("string"), 2, "0"))
    if interval == "quarter":
        return F.concat_ws("-", F.substring(start.cast("string"), 1, 4), F.quarter(start).cast("string"))
    return F.translate(F.substring(start.cast("string"), 1, _KEPT[interval]), " ", "T")


def date_histogram(df: DataFrame, field: str, interval: str, offset: int | str = 0) -> DataFrame:
    """Rows per non-empty bucket of a date field (weeks are ISO weeks)."""
    start = bucket_start(utc_time(df, field), interval, offset)
    counts = df.filter(F.col(field).isNotNull()).groupBy(start.alias("bucket")).agg(F.count("*").alias("count"))
    return counts.select(bucket_key(F.col("bucket"), interval).alias("key"), "bucket", "count")


def grouped(df: DataFrame, by, **aggregates: Column) -> DataFrame:
    """A custom aggregation: any group columns and Spark aggregates; sub-groups are more columns."""
    return df.groupBy(*by).agg(*[col.alias(name) for name, col in aggregates.items()])
