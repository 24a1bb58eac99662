"""Field selection by name, dotted path or ``*`` glob, reaching into structs and arrays of structs."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct_of(kind: T.DataType) -> T.StructType | None:
    if isinstance(kind, T.StructType):
        return kind
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return kind.elementType
    return None


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    out = []
    for f in schema.fields:
        inner = _struct_of(f.dataType)
        path = prefix + f.name
        out += leaf_paths(inner, path + ".") if inner is not None else [path]
    return out


def _named(path: str, pattern: str) -> bool:
    return fnmatchcase(path, pattern) or path.startswith(pattern + ".") or fnmatchcase(path, pattern + ".*")


def kept_paths(schema: T.StructType, include, exclude) -> list[str]:
    paths = leaf_paths(schema)
    if include:
        paths = [p for p in paths if any(_named(p, i) for i in include)]
    return [p for p in paths if not any(_named(p, e) for e in exclude)]


def _rebuild(col: Column, kind: T.DataType, keep: set[str], prefix: str) -> Column:
    inner = _struct_of(kind)
    if inner is None or set(leaf_paths(inner, prefix)) <= keep:
        return col

    def build(value: Column) -> Column:
        parts = [
            _rebuild(value[f.name], f.dataType, keep, f"{prefix}{f.name}.").alias(f.name)
            for f in inner.fields
            if any(p == prefix + f.name or p.startswith(f"{prefix}{f.name}.") for p in keep)
        ]
        return F.struct(*parts)

    if isinstance(kind, T.ArrayType):
        return F.transform(col, build)
    return F.when(col.isNotNull(), build(col))


def select_fields(df: DataFrame, include=(), exclude=(), always=()) -> DataFrame:
    """Keep the included fields (all by default) without the excluded ones; ``always`` stays."""
    include = [i for i in include if i != "*"] if "*" not in include else []
    if not include and not exclude:
        return df
    body = T.StructType([f for f in df.schema.fields if f.name not in always])
    keep = set(kept_paths(body, include, list(exclude)))
    columns = []
    for f in df.schema.fields:
        if f.name in always:
            columns.append(F.col(f"`{f.name}`"))
        elif any(p == f.name or p.startswith(f.name + ".") for p in keep):
            columns.append(_rebuild(F.col(f"`{f.name}`"), f.dataType, keep, f.name + ".").alias(f.name))
    return df.select(*columns)
