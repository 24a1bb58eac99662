"""Set-based writes as plans: upsert, patch, delete and lookup by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.plans.runtime import fits_broadcast


def _keys(frame: DataFrame, row_id: str) -> DataFrame:
    """The ids of a frame, broadcast only when measured small."""
    keys = frame.select(row_id)
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def _folded(batch: DataFrame, row_id: str, record) -> DataFrame:
    rest = [c for c in batch.columns if c != row_id]
    whole = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    return batch.groupBy(row_id).agg(record(whole).alias("r")).select(row_id, *[F.col(f"r.`{c}`") for c in rest]).select(*batch.columns)


def last_per_id(batch: DataFrame, row_id: str, sequence: str) -> DataFrame:
    """The record with the highest sequence of each id, a null one before all others; ``max_by`` combines before the shuffle."""
    place = F.struct(F.col(sequence).isNotNull().alias("known"), F.col(sequence).alias("sequence"))
    return _folded(batch, row_id, lambda whole: F.max_by(whole, place))


def unique_ids(batch: DataFrame, row_id: str) -> DataFrame:
    """The batch itself; an id that comes twice is an error, as nothing says which record is the last."""
    def only(whole: Column) -> Column:
        one = F.any_value(whole)
        return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several records of one {row_id} and no sequence"))).otherwise(one)

    return _folded(batch, row_id, only)


def upsert(old: DataFrame, batch: DataFrame, row_id: str, sequence: str | None = None) -> DataFrame:
    """Records replaced or added by id; a record without an id gets a random one.

    ``sequence`` orders several records of one id; without it ids must be unique in the batch.
    Columns unknown to the other side are null there.
    """
    given = batch.filter(F.col(row_id).isNotNull())
    given = last_per_id(given, row_id, sequence) if sequence is not None else unique_ids(given, row_id)
    kept = old.join(_keys(batch.filter(F.col(row_id).isNotNull()), row_id), row_id, "left_anti")
    # Used once, right before the write, so that a new id is drawn only once.
    unnamed = with_ids(batch.filter(F.col(row_id).isNull()), row_id)
    out = kept.unionByName(given, allowMissingColumns=True).unionByName(unnamed, allowMissingColumns=True)
    return out.drop(sequence) if sequence is not None and sequence not in old.columns else out


def with_ids(batch: DataFrame, row_id: str) -> DataFrame:
    """Random ids where they are missing; only a text id can be drawn, any other is an error."""
    kind = batch.schema[row_id].dataType
    if isinstance(kind, T.StringType):
        drawn = F.expr("uuid()")
    else:
        drawn = F.raise_error(F.lit(f"a record has no {row_id}, and a {kind.simpleString()} cannot be drawn")).cast(kind)
    return batch.withColumn(row_id, F.coalesce(F.col(row_id), drawn))


def patch(old: DataFrame, changes: DataFrame, row_id: str, provided: dict[str, Column] | None = None, sequence: str | None = None) -> DataFrame:
    """Only the provided fields change; by default a non-null value counts as provided.

    ``provided`` gives a condition per field, for setting a field to null.  Several changes of one id
    need a ``sequence``; the last one counts.
    """
    changes = changes.filter(F.col(row_id).isNotNull())
    changes = last_per_id(changes, row_id, sequence) if sequence is not None else unique_ids(changes, row_id)
    if sequence is not None and sequence not in old.columns:
        changes = changes.drop(sequence)
    fields = [c for c in changes.columns if c != row_id]
    new = changes.select(
        row_id,
        *[F.col(f"`{c}`").alias(f"__new_{c}") for c in fields],
        *[(provided or {}).get(c, F.col(f"`{c}`").isNotNull()).alias(f"__set_{c}") for c in fields],
    )
    if fits_broadcast(new):
        new = F.broadcast(new)
    joined = old.join(new, row_id, "left")
    out = []
    for c in old.columns:
        if c in fields:
            out.append(F.when(F.col(f"__set_{c}"), F.col(f"__new_{c}")).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    for c in fields:
        if c not in old.columns:
            out.append(F.when(F.col(f"__set_{c}"), F.col(f"__new_{c}")).alias(c))
    return joined.select(*out)


def unknown_ids(old: DataFrame, changes: DataFrame, row_id: str) -> DataFrame:
    """Ids of the changes that the table does not have."""
    return changes.select(row_id).join(old.select(row_id), row_id, "left_anti")


def delete(old: DataFrame, keys: DataFrame, row_id: str) -> DataFrame:
    return old.join(_keys(keys, row_id), row_id, "left_anti")


def find_by_ids(df: DataFrame, ids, row_id: str) -> DataFrame:
    """Records by a list of ids (pushed to the scan) or by a frame of ids."""
    if isinstance(ids, DataFrame):
        return df.join(_keys(ids, row_id), row_id, "left_semi")
    return df.filter(F.col(row_id).isin(list(ids)))
