"""Streaming forms of the bulk upsert and the date histogram."""

from __future__ import annotations

import datetime
import json
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tablelens.operators.aggregations import (
    _offset_minutes, bucket_key, bucket_start, instant_of, session_zone, utc_of, utc_time,
)
from tablelens.plans.runtime import ship_package
from tablelens.sources.tables import VersionedTable


def file_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One parquet table of a folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, another for every other stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").head()[0])["id"]


def ingest(stream: DataFrame, table: VersionedTable, checkpoint: str, sequence: str) -> StreamingQuery:
    """Upsert every micro-batch; a batch replayed after a failure changes nothing.

    ``sequence`` orders the records of one id.  Batches are marked by the stream's own id, so several
    streams can write into one table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, sequence, source=stream_id(batch.sparkSession, checkpoint), batch_id=batch_id)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 7 * 86_400}


def windowed_counts(stream: DataFrame, field: str, interval: str, offset: int | str = 0, late: str = "1 day") -> DataFrame:
    """Counts per window over event time, dropping rows later than ``late``.

    The watermark column stays unshifted; only the window edges follow the offset.
    """
    if interval not in _SECONDS:
        raise ValueError(f"windows are for {', '.join(_SECONDS)}, not {interval}")
    minutes, zone = _offset_minutes(offset), session_zone(stream)
    # Windows are aligned to the epoch, a Thursday; ISO weeks start four days later.
    start = (-minutes * 60 + (4 * 86_400 if interval == "week" else 0)) % _SECONDS[interval]
    utc = utc_time(stream, field)
    instant = instant_of(utc) if zone else utc.cast("timestamp")
    rows = stream.withColumn(field, instant).withWatermark(field, late)
    frame = F.window(field, f"{_SECONDS[interval]} seconds", startTime=f"{start} seconds")
    counts = rows.groupBy(frame.alias("w")).agg(F.count("*").alias("count"))
    opened = utc_of(F.col("w.start")) if zone else F.col("w.start").cast("timestamp_ntz")
    local = opened + F.expr(f"make_dt_interval(0, 0, {minutes}, 0)")
    return counts.select(bucket_key(local, interval).alias("key"), local.alias("bucket"), "count")


#: Months of a calendar bucket.
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _bucket_end(start: int, interval: str) -> int:
    """Seconds at which the bucket that starts at ``start`` (local seconds) ends."""
    first = datetime.datetime.fromtimestamp(start, datetime.UTC)
    months = first.year * 12 + first.month - 1 + _MONTHS[interval]
    return int(datetime.datetime(months // 12, months % 12 + 1, 1, tzinfo=datetime.UTC).timestamp())


def calendar_counts(stream: DataFrame, field: str, interval: str, offset: int | str = 0, late: str = "1 day", closed_only: bool = True) -> DataFrame:
    """Counts per month, quarter or year, which have no fixed length and so are no windows.

    With ``closed_only`` a bucket is given once, when the watermark (the newest time less ``late``) has passed its end.
    No row within the delay is lost, rows of a closed bucket always are, and others older than the watermark may be: its count is a state of its own with an event-time timer.  Tasks count
    their own batches first, so a crowded month is a few rows for its state.  Otherwise all buckets are kept and nothing is dropped.
    """
    minutes = _offset_minutes(offset)
    utc = utc_time(stream, field)
    start = bucket_start(utc, interval, offset)
    rows = stream.filter(F.col(field).isNotNull())
    if closed_only:
        ship_package()
        rows = rows.select(F.unix_seconds(instant_of(start)).alias("start"), instant_of(utc).alias("newest"))

        def counted(batches):
            for batch in batches:
                found = pa.Table.from_batches([batch]).group_by("start").aggregate([("newest", "max"), ("newest", "count")])
                yield from found.select(["start", "newest_max", "newest_count"]).rename_columns(["start", "newest", "n"]).to_batches()

        def keep(key, frames, state):
            end = (_bucket_end(key[0], interval) - minutes * 60) * 1000
            if state.hasTimedOut:
                found = state.get[0]
                state.remove()
                yield pd.DataFrame({"start": [key[0]], "count": [found]})
            elif state.getCurrentWatermarkMs() < end:
                new = sum(int(f["n"].sum()) for f in frames)
                state.update(((state.get[0] if state.exists else 0) + new,))
                state.setTimeoutTimestamp(end)

        partial = rows.mapInArrow(counted, "start long, newest timestamp, n long").withWatermark("newest", late)
        counts = partial.groupBy("start").applyInPandasWithState(keep, "start long, count long", "n long", "append", GroupStateTimeout.EventTimeTimeout)
        opened = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, start)")
        counts = counts.select(opened.alias("bucket"), "count")
    else:
        counts = rows.groupBy(start.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(bucket_key(F.col("bucket"), interval).alias("key"), "bucket", "count")


def stream_histogram(
    stream: DataFrame, field: str, interval: str, path: str, checkpoint: str, offset: int | str = 0, late: str = "1 day",
    mode: str = "complete", view: str | None = None,
) -> StreamingQuery:
    """Keep a histogram up to date: ``append`` adds closed buckets to ``path``; ``complete`` writes a folder of
    its own per batch below ``path`` and then moves ``view``, so readers never see a half-written one."""
    if interval in _MONTHS:
        counts = calendar_counts(stream, field, interval, offset, late, mode == "append")
    else:
        counts = windowed_counts(stream, field, interval, offset, late)
    writer = counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").option("path", path).start()
    if view is None:
        raise ValueError("a complete histogram needs the name of its view")

    def publish(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        batch.write.parquet(folder)
        batch.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{folder}`")

    return writer.foreachBatch(publish).start()
