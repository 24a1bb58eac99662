"""Wildcards on large keyword columns: postings of three-letter pieces, intersected before any value is looked at."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelens.plans.conditions import Wildcard
from tablelens.plans.runtime import fits_broadcast

#: Marks the two ends of a value; a value that holds them is only found a little less selectively.
FIRST, LAST = "\x02", "\x03"


def pieces(value: Column) -> Column:
    """Distinct pieces of three characters of the value between its end marks."""
    marked = F.concat(F.lit(FIRST), value, F.lit(LAST))
    places = F.sequence(F.lit(1), F.greatest(F.char_length(marked) - 2, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(marked, i, F.lit(3))))


def pattern_pieces(pattern: str) -> list[str]:
    """Pieces that every matching value has."""
    runs = re.split(r"[*?]", FIRST + pattern + LAST)
    return sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})


class WildcardIndex:
    """Distinct values of a column by their pieces, and the ids of each value, both stored in order.

    A pattern reads the postings of its own pieces; values that have them all are checked against the pattern, and only
    the ids of those that match are read.  A pattern without three fixed characters in a row has no piece: it checks every distinct value.
    """

    def __init__(self, grams: DataFrame, values: DataFrame):
        self.grams, self.values = grams, values

    @classmethod
    def write(cls, df: DataFrame, row_id: str, field: str, folder: str) -> WildcardIndex:
        rows = df.filter(F.col(field).isNotNull()).select(F.col(field).alias("value"), F.col(row_id).alias("id"))
        rows.repartitionByRange("value", "id").sortWithinPartitions("value", "id").write.mode("overwrite").parquet(f"{folder}/values")
        stored = df.sparkSession.read.parquet(f"{folder}/values")
        grams = stored.select("value").distinct().select(F.explode(pieces(F.col("value"))).alias("piece"), "value")
        grams.repartitionByRange("piece", "value").sortWithinPartitions("piece", "value").write.mode("overwrite").parquet(f"{folder}/pieces")
        return cls.open(df.sparkSession, folder)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> WildcardIndex:
        return cls(spark.read.parquet(f"{folder}/pieces"), spark.read.parquet(f"{folder}/values"))

    def matching_values(self, pattern: str) -> DataFrame:
        """Distinct values that match as a whole; ``*`` is any run and ``?`` one character."""
        asked = pattern_pieces(pattern)
        like = F.col("value").like(Wildcard("value", pattern)._like())
        if not asked:
            return self.values.filter(like).select("value").distinct()
        # each piece is a filter of its own range for the scan; a value has a piece once
        held = self.grams.filter(F.col("piece").isin(asked)).groupBy("value").agg(F.count(F.lit(1)).alias("pieces"))
        return held.filter((F.col("pieces") == len(asked)) & like).select("value")

    def matching_ids(self, pattern: str) -> DataFrame:
        """The ids of the rows whose value matches."""
        found = self.matching_values(pattern)
        small = F.broadcast(found) if fits_broadcast(found) else found
        return self.values.join(small, "value", "left_semi").select("id")
