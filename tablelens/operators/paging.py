"""Sort keys, offset pages and keyset pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.plans.scope import field_type


@dataclass(frozen=True)
class SortKey:
    field: str
    descending: bool = False

    def value(self, schema: T.StructType) -> Column:
        """An array sorts by its smallest value ascending and its largest descending."""
        kind = field_type(schema, self.field)
        col = F.col(self.field)
        if isinstance(kind, T.ArrayType):
            return F.array_max(col) if self.descending else F.array_min(col)
        return col

    def order(self, schema: T.StructType) -> Column:
        value = self.value(schema)
        return value.desc_nulls_last() if self.descending else value.asc_nulls_last()

    def past(self, schema: T.StructType, last) -> Column:
        """Strictly after ``last`` in this key's order, where nulls come last."""
        value = self.value(schema)
        if last is None:
            return F.lit(False)
        beyond = value < F.lit(last) if self.descending else value > F.lit(last)
        return value.isNull() | beyond

    def same(self, schema: T.StructType, last) -> Column:
        return self.value(schema).eqNullSafe(F.lit(last))


def sort_keys(spec, direction: str | None = None) -> list[SortKey]:
    """``'f'``, ``'-f'``, ``('f', 'desc')`` via ``direction``, ``{f: dir}`` or a list of those."""
    if isinstance(spec, str):
        if spec.startswith("-"):
            return [SortKey(spec[1:], True)]
        default = "desc" if spec == "_score" else "asc"
        return [SortKey(spec, (direction or default).lower() == "desc")]
    if isinstance(spec, dict):
        return [SortKey(f, _direction(d) == "desc") for f, d in spec.items()]
    if isinstance(spec, tuple) and len(spec) == 2 and isinstance(spec[1], str) and spec[1].lower() in ("asc", "desc"):
        return sort_keys(spec[0], spec[1])
    return [key for item in spec for key in sort_keys(item)]


def _direction(value) -> str:
    return (value["order"] if isinstance(value, dict) else value).lower()


def with_tie_break(keys: list[SortKey], row_id: str) -> list[SortKey]:
    return keys if any(k.field == row_id for k in keys) else [*keys, SortKey(row_id)]


def after(df: DataFrame, keys: list[SortKey], values) -> DataFrame:
    """Rows after the given sort values; fewer values than keys compare the leading keys only."""
    schema = df.schema
    used = list(zip(keys, values))
    steps = []
    for i, (key, last) in enumerate(used):
        equal = [k.same(schema, v) for k, v in used[:i]]
        step = key.past(schema, last)
        for e in reversed(equal):
            step = e & step
        steps.append(step)
    condition = steps[0]
    for step in steps[1:]:
        condition = condition | step
    # The bound on the first key alone follows from the rest; it is the part a scan can use.
    first, last = used[0]
    if last is not None:
        condition = (first.past(schema, last) | first.same(schema, last)) & condition
    return df.filter(condition)


def ordered(df: DataFrame, keys: list[SortKey]) -> DataFrame:
    return df.orderBy(*[k.order(df.schema) for k in keys])


def page(df: DataFrame, limit: int | None, number: int = 1) -> DataFrame:
    """Page ``number`` counts from 1 and only has meaning with a limit."""
    if limit is None:
        return df
    skip = limit * (number - 1) if number and number > 1 else 0
    return (df.offset(skip) if skip else df).limit(limit)
