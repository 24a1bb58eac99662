"""Exact duplicates, with frequent digests split off before the shuffle.

A digest that many rows share would fill one task of an ordinary grouping.  Misra-Gries summaries
(one of ``counters`` entries per task, merged) name every digest that could be frequent; exact
winners of those few are computed with map-side combine and broadcast, so their rows never
move.  All other digests are grouped by an ordinary shuffle, each at most 2 / counters of all rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import SPACES, prepared, texts
from tablelens.plans.runtime import written

COUNTERS = 1024


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the text without its ASCII white space."""
    return F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)


def reduced(counts: Counter, counters: int) -> Counter:
    """At most ``counters`` entries: every entry lowered by the largest that would have to go."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def frequent(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values, among them each that holds over 2 / counters of the rows.

    A task's summary undercounts by at most its rows / counters; summed over tasks, a value of
    more than 2 n / counters rows keeps over n / counters, and fewer than ``counters`` values can.
    """
    kind = digests.schema[column].dataType.simpleString()

    def summary(batches):
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            counts = reduced(counts, counters)
        counts.pop(None, None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["value", "n"]
        )

    parts = prepared(digests).select(F.col(column).cast("string")).mapInArrow(summary, "value string, n long")
    totals = parts.groupBy("value").agg(F.sum("n").alias("n")).filter("n > 1")
    return totals.orderBy(F.desc("n"), "value").limit(counters).select(F.col("value").cast(kind).alias(column))


def best() -> Column:
    """The row that stays: most code points, then the smallest id (null last), then the first occurrence."""
    return F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row.

    Null texts count as empty, empty texts form one group; ties go to the smallest id; of fully
    repeated rows exactly one is kept; a null id loses ties.  An empty table gives no rows.
    """
    rows = texts(docs, doc_id, text).select(
        "doc_id",
        text_digest("text").alias("text_sha256"),
        F.char_length("text").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "digests")  # texts are read once, and row numbers stay as they are
    heavy = written(frequent(rows, "text_sha256", counters), "frequent")
    small = F.broadcast(heavy)  # at most ``counters`` digests

    def decided(grouped: DataFrame) -> DataFrame:
        return grouped.groupBy("text_sha256").agg(best().alias("best"), F.count(F.lit(1)).alias("group_size"))

    winners = decided(rows.join(small, "text_sha256", "left_semi"))
    hot = rows.join(F.broadcast(winners), "text_sha256")
    light = rows.join(small, "text_sha256", "left_anti")
    cold = light.join(decided(light), "text_sha256")
    return hot.unionByName(cold).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "row",
    )


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, all columns as they came."""
    answers = exact_duplicates(docs, doc_id, text, counters)
    verdicts = answers.groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("copies")
    )
    lost = verdicts.filter("not stays or copies > 1").withColumnsRenamed({"doc_id": "__id", "text_sha256": "__digest", "copies": "__copies", "stays": "__stays"})
    keyed = docs.withColumn("__key", text_digest(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    joined = keyed.join(lost, (F.col(f"`{doc_id}`").eqNullSafe(F.col("__id"))) & (F.col("__key") == F.col("__digest")), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = joined.filter("__stays is null").select(*columns)
    # the same id and text several times: one of them stays, the longest original first
    again = joined.filter("__stays").withColumn("__chars", F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    longest = again.groupBy("__id", "__digest").agg(F.max("__chars").alias("__most"))
    again = again.join(longest.withColumnsRenamed({"__id": "__i", "__digest": "__d"}), F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__digest") == F.col("__d")) & (F.col("__chars") == F.col("__most")))
    return once.unionByName(again.dropDuplicates(["__id", "__digest"]).select(*columns))
