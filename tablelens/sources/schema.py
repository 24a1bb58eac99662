"""Declared schemas: type names, typed loading of raw records, drift between table and declaration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and the Spark types they load as.
TYPES = {
    "binary": T.BinaryType(), "boolean": T.BooleanType(),
    "keyword": T.StringType(), "constant_keyword": T.StringType(), "wildcard": T.StringType(),
    "long": T.LongType(), "integer": T.IntegerType(), "short": T.ShortType(), "byte": T.ByteType(),
    "double": T.DoubleType(), "float": T.FloatType(), "half_float": T.FloatType(),
    "scaled_float": T.DecimalType(18, 2), "unsigned_long": T.DecimalType(20, 0),
    "date": T.TimestampType(), "date_nanos": T.TimestampType(),
    "text": T.StringType(), "match_only_text": T.StringType(), "completion": T.StringType(),
    "search_as_you_type": T.StringType(), "semantic_text": T.StringType(),
    "token_count": T.IntegerType(), "dense_vector": T.ArrayType(T.FloatType()),
}
TEXT_TYPES = ("text", "match_only_text", "search_as_you_type", "semantic_text")

Declaration = dict[str, "str | dict"]


def struct_type(declared: Declaration) -> T.StructType:
    """A declaration as a Spark schema; a sub-map is an array of structs."""
    out = []
    for name, kind in declared.items():
        if isinstance(kind, dict):
            out.append(T.StructField(name, T.ArrayType(struct_type(kind))))
            continue
        base = kind.split(".", 1)[0]
        if base not in TYPES:
            raise ValueError(f"unknown type {kind} of field {name}")
        out.append(T.StructField(name, TYPES[base]))
    return T.StructType(out)


def with_properties(declared: Declaration, properties: Declaration) -> Declaration:
    """The declaration with extra properties, which win on conflict."""
    return {**declared, **properties}


def all_fields(declared: Declaration, prefix: str = "") -> list[str]:
    out = []
    for name, kind in declared.items():
        out += all_fields(kind, f"{prefix}{name}.") if isinstance(kind, dict) else [prefix + name]
    return out


def fulltext_fields(declared: Declaration, prefix: str = "") -> list[str]:
    out = []
    for name, kind in declared.items():
        if isinstance(kind, dict):
            out += fulltext_fields(kind, f"{prefix}{name}.")
        elif kind in TEXT_TYPES:
            out.append(prefix + name)
    return out


def _cast(col: Column, source: T.DataType, kind: str, target: T.DataType) -> Column:
    if kind == "date.epoch_second":
        return F.timestamp_seconds(col.try_cast("double"))
    if kind == "date.epoch_millis":
        return F.timestamp_millis(col.try_cast("long"))
    if kind == "binary" and isinstance(source, T.StringType):
        return F.try_to_binary(col, F.lit("base64"))
    if isinstance(source, T.ArrayType) and not isinstance(target, T.ArrayType):
        return F.transform(col, lambda v: _cast(v, source.elementType, kind, target))
    return col.try_cast(target)


def _typed(col: Column, source: T.DataType, kind, target: T.DataType) -> Column:
    if not isinstance(kind, dict):
        return _cast(col, source, kind, target)
    one = isinstance(source, T.StructType)
    inner = source if one else source.elementType

    def build(value: Column) -> Column:
        fields = []
        for f in target.elementType.fields:
            if f.name in inner.fieldNames():
                made = _typed(value[f.name], inner[f.name].dataType, kind[f.name], f.dataType)
            else:
                made = F.lit(None).cast(f.dataType)
            fields.append(made.alias(f.name))
        return F.struct(*fields)

    return F.when(col.isNotNull(), F.array(build(col)) if one else F.transform(col, build))


def load_records(raw: DataFrame, declared: Declaration) -> DataFrame:
    """Raw records in the declared types; values that do not convert become null, other columns stay.

    A single object in a nested field becomes a one-element array.
    """
    target = struct_type(declared)
    columns = []
    for f in target.fields:
        if f.name in raw.columns:
            made = _typed(F.col(f"`{f.name}`"), raw.schema[f.name].dataType, declared[f.name], f.dataType)
        else:
            made = F.lit(None).cast(f.dataType)
        columns.append(made.alias(f.name))
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in target.fieldNames()]
    return raw.select(*columns, *extra)


def _losses(source: T.DataType, kind, target: T.DataType, path: str) -> list:
    """``(path, test)`` per leaf: whether a value is present and its cast is not."""
    if isinstance(kind, dict):
        one = isinstance(source, T.StructType)
        inner, out = (source if one else source.elementType), []
        for f in target.elementType.fields:
            if f.name not in inner.fieldNames():
                continue
            for leaf, test in _losses(inner[f.name].dataType, kind[f.name], f.dataType, f"{path}.{f.name}"):
                out.append((leaf, _in_elements(one, f.name, test)))
        return out
    if isinstance(source, T.ArrayType) and not isinstance(target, T.ArrayType):
        return [(path, lambda col: F.exists(col, lambda v: _lost(v, source.elementType, kind, target)))]
    return [(path, lambda col: _lost(col, source, kind, target))]


def _lost(value: Column, source: T.DataType, kind: str, target: T.DataType) -> Column:
    return value.isNotNull() & _cast(value, source, kind, target).isNull()


def _in_elements(one: bool, name: str, test):
    if one:
        return lambda col: col.isNotNull() & test(col[name])
    return lambda col: F.exists(col, lambda e: test(e[name]))


def _failing(df: DataFrame, declared: Declaration) -> dict[str, Column]:
    """Count of rows per leaf whose value does not convert."""
    out = {}
    for name in declared:
        if name in df.columns:
            target = struct_type({name: declared[name]})[name].dataType
            for path, test in _losses(df.schema[name].dataType, declared[name], target, name):
                out[path] = F.count_if(test(F.col(f"`{name}`")))
    return out


def _as_rows(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def rejected_values(raw: DataFrame, declared: Declaration) -> DataFrame:
    """``(column, rejected)``: rows per column whose value does not convert, in one pass."""
    failing = _failing(raw, declared)
    return _as_rows(raw, [F.struct(F.lit(p).alias("column"), n.alias("rejected")) for p, n in failing.items()])


def drift(df: DataFrame, declared: Declaration) -> DataFrame:
    """``(column, status, found, declared, failing)`` for every column of either side.

    ``status`` is same, missing, extra or retyped; ``failing`` counts values the cast would lose.
    """
    target = struct_type(declared)
    failing = _failing(df, declared)
    rows = []

    def add(name, status, found, wanted, count=None):
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(status).alias("status"),
                F.lit(found).cast("string").alias("found"),
                F.lit(wanted).cast("string").alias("declared"),
                (F.lit(0).cast("long") if count is None else count).alias("failing"),
            )
        )

    for f in target.fields:
        if f.name not in df.columns:
            add(f.name, "missing", None, f.dataType.simpleString())
            continue
        found = df.schema[f.name].dataType
        counts = [n for path, n in failing.items() if path == f.name or path.startswith(f.name + ".")]
        status = "same" if found == f.dataType else "retyped"
        add(f.name, status, found.simpleString(), f.dataType.simpleString(), reduce(lambda a, b: a + b, counts))
    for f in df.schema.fields:
        if f.name not in target.fieldNames():
            add(f.name, "extra", f.dataType.simpleString(), None)
    return _as_rows(df, rows)


def union_open(frames: list[DataFrame]) -> DataFrame:
    """Records with different columns together; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
