"""Combining ranked lists.

A list is a frame ``(keys…, id, _score)``; ``by`` names the keys when many queries run at once.
Rank fusion combines each list's best ``window`` rows; weighted fusion combines whole lists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_SIZE, RANK_CONSTANT = 50, 20


def top_of(ranked: DataFrame, row_id: str, window: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The best rows of a list with their 1-based rank."""
    order = [F.desc("_score"), F.asc(row_id)]
    if not by:
        # The limit is planned as a per-task top-k; the numbering then sees only `window` rows.
        best = ranked.orderBy(*order).limit(window)
        return best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= window)


def scaled(ranked: DataFrame, by: tuple[str, ...] = (), name: str = "scaled") -> DataFrame:
    """The list with its score scaled to [0, 1] within the list; 1.0 when all scores are equal.

    The bounds are one aggregate per list, so a list of any length stays distributed.
    """
    score, bounds = F.col("_score"), F.struct(F.min("_score").alias("low"), F.max("_score").alias("high")).alias("__bounds")
    if by:
        ranked = ranked.join(ranked.groupBy(*by).agg(bounds), list(by))
    else:
        ranked = ranked.withColumn("__bounds", ranked.select(bounds).scalar())
    low, high = F.col("__bounds.low"), F.col("__bounds.high")
    return ranked.withColumn(name, F.when(high > low, (score - low) / (high - low)).otherwise(1.0)).drop("__bounds")


def _sum_up(lists: list[DataFrame], row_id: str, by: tuple[str, ...]) -> DataFrame:
    union = reduce(lambda a, b: a.unionByName(b), lists)
    return union.groupBy(*by, row_id).agg(F.round(F.sum("part"), 12).alias("_score"))


def reciprocal_rank(
    lists: list[DataFrame],
    row_id: str,
    window: int = WINDOW_SIZE,
    constant: int = RANK_CONSTANT,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Sum over the lists of 1 / (constant + rank) (Cormack, Clarke and Büttcher 2009)."""
    parts = [
        top_of(ranked, row_id, window, by).select(*by, row_id, (1.0 / (F.col("rank") + constant)).alias("part"))
        for ranked in lists
    ]
    return _sum_up(parts, row_id, by)


def weighted(
    lists: list[tuple[DataFrame, float]],
    row_id: str,
    window: int | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Weighted sum of min-max scaled scores; a list that lacks a row adds 0; one list is used as is.

    Lists take part whole; a ``window`` keeps only the best rows of each.
    """
    if window is not None:
        lists = [(top_of(ranked, row_id, window, by).drop("rank"), weight) for ranked, weight in lists]
    if len(lists) == 1:
        return lists[0][0].select(*by, row_id, "_score")
    parts = [
        scaled(ranked, by).select(*by, row_id, (F.col("scaled") * F.lit(float(weight))).alias("part"))
        for ranked, weight in lists
    ]
    return _sum_up(parts, row_id, by)


def rescored_top(
    df: DataFrame, row_id: str, phases: list[tuple[int, Column]], wanted: int, tier: str = "_tier"
) -> DataFrame:
    """:func:`rescored` for the best ``wanted`` rows: one pass over the rows, however many phases.

    Rows below the largest window keep their order, so a top-k as long as that window and the page
    holds everything; the phases number that bounded set.
    """
    df = top_of(df.withColumn(tier, F.lit(0)), row_id, max(wanted, *[w for w, _ in phases])).drop("rank")
    for window, extra in phases:
        order = Window.partitionBy(F.lit(0)).orderBy(F.desc(tier), F.desc("_score"), F.asc(row_id))
        df = df.withColumn("__inside", F.row_number().over(order) <= window)
        df = df.withColumns(
            {
                "_score": F.when(F.col("__inside"), F.col("_score") + extra).otherwise(F.col("_score")),
                tier: F.col(tier) + F.col("__inside").cast("int"),
            }
        ).drop("__inside")
    return df


def rescored(df: DataFrame, row_id: str, window: int, extra: Column, tier: str = "_tier") -> DataFrame:
    """Add ``extra`` to the score of the best ``window`` rows and rank those first.

    The window's last row is found by a top-k scalar subquery; rows are then compared with it, so
    neither a join nor a global numbering is needed.
    """
    if tier not in df.columns:
        df = df.withColumn(tier, F.lit(0))
    order = [F.desc(tier), F.desc("_score"), F.asc(row_id)]
    back = [F.asc("t"), F.asc("s"), F.desc("i")]
    last = (
        df.orderBy(*order)
        .limit(window)
        .select(F.col(tier).alias("t"), F.col("_score").alias("s"), F.col(row_id).alias("i"))
        .orderBy(*back)
        .limit(1)
        .select(F.struct("t", "s", "i"))
        .scalar()
    )
    df = df.withColumn("__last", last)
    t, s, i = F.col("__last.t"), F.col("__last.s"), F.col("__last.i")
    inside = (F.col(tier) > t) | (
        (F.col(tier) == t) & ((F.col("_score") > s) | ((F.col("_score") == s) & (F.col(row_id) <= i)))
    )
    df = df.withColumn("__inside", inside)
    return df.withColumns(
        {
            "_score": F.when(F.col("__inside"), F.col("_score") + extra).otherwise(F.col("_score")),
            tier: F.col(tier) + F.col("__inside").cast("int"),
        }
    ).drop("__last", "__inside")
