"""Versioned tables behind a view.

A snapshot is a catalog table whose hash buckets are partitions with a location each.  A write
rewrites only the buckets it touches and publishes a new snapshot that shares the other buckets'
files, then points the view at it; readers see the old snapshot or the new one.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.plans.runtime import hadoop_path, shared_folder, written
from tablelens.sources import changes
from tablelens.sources.schema import Declaration, drift, load_records, struct_type

BUCKET = "__bucket"
#: Properties that say which batches of a stream the table holds.
MARK = "batch."
#: Size of a bucket's files above which a migration doubles the number of buckets.
BUCKET_BYTES = 256 << 20
#: How often a write is made again because another one was published first.
ATTEMPTS = 10
NAME = re.compile(r"[a-z0-9][a-z0-9_]*")


def alias_name(name: str, language: str = "english", prefix: str = "") -> str:
    parts = [p for p in (prefix, language, name) if p]
    for part in parts:
        if not NAME.fullmatch(part) or len(part) > 200:
            raise ValueError(f"Index name part is not a plain lower-case name: {part!r}")
    return "__".join(parts)


def table_name(alias: str, version: int) -> str:
    return f"{alias}__v{version}"


def row_hash(columns: list[str]) -> Column:
    """Order-free hash of a set of rows."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")
    return F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)"))


class SnapshotMoved(RuntimeError):
    """The view shows another snapshot than the one a write was based on."""


@dataclass
class Snapshot:
    table: str
    version: int
    buckets: int
    row_id: str
    locations: dict[int, str]
    properties: dict[str, str]


class VersionedTable:
    """One alias: its declared schema, id column and current snapshot.

    ``buckets`` is the number a new table starts with.  A migration doubles it until a bucket's files
    hold at most ``bucket_bytes``, so that a write to a few ids rewrites about as much however large the
    table is: bucket b of n then splits into b and b + n.
    """

    def __init__(self, spark: SparkSession, alias: str, declared: Declaration, row_id: str = "id", buckets: int = 64,
                 folder: str | None = None, sort_by: tuple[str, ...] = (), bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.alias, self.declared, self.row_id = spark, alias, declared, row_id
        self.buckets, self.sort_by, self.bucket_bytes = buckets, sort_by, bucket_bytes
        self.folder = folder or f"{shared_folder(spark)}/tables"

    # Catalog --------------------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.alias)

    def properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.alias}").collect()
        return {r["key"]: r["value"] for r in rows}

    def snapshot(self) -> Snapshot:
        found = self.properties()
        table = found["snapshot"]
        return Snapshot(
            table, int(found["version"]), int(found["buckets"]), found["row_id"], self._locations(table), found
        )

    def _locations(self, table: str) -> dict[int, str]:
        """Bucket folders of a snapshot, from the list written with it (one row per bucket)."""
        rows = self.spark.read.schema("bucket int, place string").parquet(f"{self.folder}/{table}-buckets").collect()
        return {r["bucket"]: r["place"] for r in rows}

    def _publish(
        self, schema: T.StructType, version: int, buckets: int, places: dict[int, str], extra: dict[str, str], after: Snapshot | None = None
    ) -> str:
        """Register the snapshot's buckets, then switch the view.

        With ``after``, only if the view still shows that snapshot (else :class:`SnapshotMoved`), and the
        marks of its stream batches are carried on.
        """
        table = f"{table_name(self.alias, version)}__{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet "
            f"PARTITIONED BY ({BUCKET}) LOCATION '{self.folder}/{table}'"
        )
        if places:
            parts = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{p}'" for b, p in sorted(places.items()))
            self.spark.sql(f"ALTER TABLE {table} ADD {parts}")
        listed = self.spark.createDataFrame(sorted(places.items()), "bucket int, place string")
        listed.coalesce(1).write.parquet(f"{self.folder}/{table}-buckets")
        marks = {}
        if after is not None:
            if self.properties()["snapshot"] != after.table:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
                raise SnapshotMoved(f"{self.alias} was written meanwhile")
            marks = {k: v for k, v in after.properties.items() if k.startswith(MARK)}
        facts = {"snapshot": table, "version": str(version), "buckets": str(buckets), "row_id": self.row_id, **marks, **extra}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in facts.items())
        names = ", ".join(f"`{f.name}`" for f in schema.fields)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.alias} TBLPROPERTIES ({listed}) AS SELECT {names} FROM {table}")
        return table

    def _bucketed(self, df: DataFrame, buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(self.row_id), F.lit(buckets)).cast("int"))

    def _write(self, df: DataFrame, buckets: int) -> dict[int, str]:
        """Write rows by bucket; the rebalance keeps file sizes even without one task per bucket."""
        path = f"{self.folder}/{self.alias}/{uuid.uuid4().hex}"
        rows = self._bucketed(df, buckets).hint("rebalance", BUCKET)
        if self.sort_by:
            rows = rows.sortWithinPartitions(BUCKET, *self.sort_by)
        rows.write.partitionBy(BUCKET).parquet(path)
        return {int(place.rsplit("=", 1)[1]): place for place in self._folders(path)}

    # Reads ----------------------------------------------------------------------

    def read(self) -> DataFrame:
        return self.spark.table(self.alias)

    def find_by_ids(self, ids) -> DataFrame:
        """Records by id; a list of ids reads only their buckets."""
        if isinstance(ids, DataFrame):
            return changes.find_by_ids(self.read(), ids, self.row_id)
        now = self.snapshot()
        kind = self.read().schema[self.row_id].dataType
        wanted = [F.pmod(F.xxhash64(F.lit(i).cast(kind)), F.lit(now.buckets)).cast("int") for i in ids]
        rows = self.spark.table(now.table).filter(F.col(BUCKET).isin(wanted) & F.col(self.row_id).isin(list(ids)))
        return rows.drop(BUCKET)

    # Writes ---------------------------------------------------------------------

    def create(self, df: DataFrame | None = None, version: int = 1) -> None:
        if df is None:
            df = self.spark.createDataFrame([], struct_type(self.declared))
        places = self._write(df, self.buckets)
        self._publish(df.schema, version, self.buckets, places, {})

    def _rewrite(self, touched: DataFrame, make, extra: dict[str, str] | None = None) -> None:
        """Apply ``make`` to the rows of the touched buckets and publish; done again when another write came first."""
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            try:
                schema, places = self._changed(now.table, now.locations, now.buckets, touched, make)
                return self._replace(now, schema, places, extra or {})
            except SnapshotMoved:
                continue
        raise SnapshotMoved(f"{self.alias} was written by others {ATTEMPTS} times")

    def _changed(self, table: str, locations: dict[int, str], buckets: int, touched: DataFrame, make):
        """Schema and bucket folders after ``make`` on the touched buckets of a table; the other folders are shared."""
        numbers = [r[0] for r in self._bucketed(touched.select(self.row_id), buckets).select(BUCKET).distinct().collect()]
        whole = self.spark.table(table)
        new = make(whole.filter(F.col(BUCKET).isin(numbers)).drop(BUCKET))
        places = self._write(new, buckets)
        kept = {b: p for b, p in locations.items() if b not in numbers}
        return (new if places else whole.drop(BUCKET)).schema, {**kept, **places}

    def _replace(self, now: Snapshot, schema: T.StructType, places: dict[int, str], extra: dict[str, str]) -> None:
        """Publish a successor; the replaced snapshot stays for its readers until the next write."""
        self._publish(schema, now.version, now.buckets, places, {**extra, "previous": now.table}, after=now)
        if "previous" in now.properties:
            self.spark.sql(f"DROP TABLE IF EXISTS {now.properties['previous']}")

    def remove_unused_files(self) -> int:
        """Delete bucket folders that neither the current nor the previous snapshot uses.

        Not to be run while a write is in progress.
        """
        now = self.snapshot()
        tables = [now.table, *([now.properties["previous"]] if "previous" in now.properties else [])]
        used = {p.rstrip("/").split("/", 1)[1].lstrip("/") for t in tables for p in self._locations(t).values()}
        removed = 0
        for batch in self._folders(f"{self.folder}/{self.alias}"):
            for place in self._folders(batch):
                if place.split("/", 1)[1].lstrip("/") not in used:
                    path, files = hadoop_path(self.spark, place)
                    removed += files.delete(path, True)
        return removed

    def _folders(self, folder: str) -> list[str]:
        path, files = hadoop_path(self.spark, folder)
        return [f.getPath().toString() for f in files.listStatus(path) if f.isDirectory()] if files.exists(path) else []

    def stored_bytes(self, snapshot: Snapshot) -> int:
        """Size of a snapshot's files."""
        places = [hadoop_path(self.spark, p) for p in snapshot.locations.values()]
        return sum(files.getContentSummary(path).getLength() for path, files in places)

    def _grown(self, snapshot: Snapshot) -> int:
        """Buckets for a copy of the snapshot, as many times doubled as its size asks for."""
        size, buckets = self.stored_bytes(snapshot), self.buckets
        while size > buckets * self.bucket_bytes:
            buckets *= 2
        return buckets

    def upsert(self, batch: DataFrame, sequence: str | None = None, source: str = "", batch_id: int | None = None) -> bool:
        """Write a batch by id; a repeated ``batch_id`` of a source is skipped and returns False.

        ``sequence`` says which of several records of one id is the last; without it such a batch is
        refused.  ``source`` must be one stream's own name.  The batch is written to the shared
        folder first: it is read several times, and a record without an id gets its random one only once.
        """
        mark = f"{MARK}{source}"
        if batch_id is not None and int(self.properties().get(mark, -1)) >= batch_id:
            return False
        batch = written(changes.with_ids(batch, self.row_id), "batch")
        extra = {mark: str(batch_id)} if batch_id is not None else {}
        self._rewrite(batch, lambda old: changes.upsert(old, batch, self.row_id, sequence), extra)
        return True

    def patch(self, batch: DataFrame, provided: dict[str, Column] | None = None, sequence: str | None = None) -> DataFrame:
        """Change the provided fields; returns the ids the table does not have."""
        self._rewrite(batch, lambda old: changes.patch(old, batch, self.row_id, provided, sequence))
        return changes.unknown_ids(self.read(), batch, self.row_id)

    def delete(self, keys: DataFrame) -> None:
        self._rewrite(keys, lambda old: changes.delete(old, keys, self.row_id))

    def delete_all(self) -> None:
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            try:
                return self._replace(now, self.read().schema, {}, {})
            except SnapshotMoved:
                continue
        raise SnapshotMoved(f"{self.alias} was written by others {ATTEMPTS} times")

    # Versions -------------------------------------------------------------------

    def status(self) -> DataFrame:
        """Drift between the table and the declared schema; without a table every column is missing."""
        found = self.read() if self.exists() else self.spark.createDataFrame([], T.StructType([]))
        return drift(found, self.declared)

    def migrate(self, version: int) -> dict:
        """Bring the alias to ``version`` with the declared schema.

        Rows are copied, compared by count and hash, and only then does the view move.  Rows that were
        added, changed or deleted while the copy ran are brought over before that, as often as needed.
        """
        report = {"table": self.alias, "rows_old": 0, "rows_new": 0, "hash_equal": True}
        if not self.exists():
            self.create(version=version)
            return {**report, "code": "CREATED_INDEX"}
        now = self.snapshot()
        if now.version >= version:
            rows = self.read().count()
            return {**report, "code": "NO_CHANGE", "rows_old": rows, "rows_new": rows}
        schema, buckets = self.read().schema, self._grown(now)
        places = self._write(self._loaded(now, schema), buckets)
        for _ in range(ATTEMPTS):
            target = self._loaded(now, schema)
            stored = self.spark.read.schema(target.schema).parquet(*places.values()) if places else target.limit(0)
            compare = [F.count("*").alias("n"), row_hash(target.columns).alias("h")]
            before, after = target.agg(*compare).head(), stored.agg(*compare).head()
            report |= {"rows_old": before["n"], "rows_new": after["n"], "hash_equal": before["h"] == after["h"]}
            if before["n"] != after["n"] or before["h"] != after["h"]:
                return {**report, "code": "ERROR_COPY"}
            try:
                self._publish(target.schema, version, buckets, places, {}, after=now)
                self.spark.sql(f"DROP TABLE IF EXISTS {now.table}")
                return {**report, "code": "MIGRATED"}
            except SnapshotMoved:
                latest = self.snapshot()
                if latest.version >= version:
                    rows = self.read().count()
                    return {**report, "code": "NO_CHANGE", "rows_old": rows, "rows_new": rows}
                late, schema = self._rewritten(now, latest), self.read().schema
                before, after = self._loaded(now, schema, late), self._loaded(latest, schema, late)
                places = self._caught_up(places, buckets, before, after)
                now = latest
        raise SnapshotMoved(f"{self.alias} was written by others {ATTEMPTS} times")

    def rebuild(self, version: int, records: DataFrame) -> dict:
        """Bring the alias to ``version`` from its source records; the rows of the old version are replaced."""
        loaded = load_records(records, self.declared)
        rows = self.read().count() if self.exists() else 0
        report = {"table": self.alias, "rows_old": rows, "hash_equal": True, "code": "REBUILT"}
        places = self._write(loaded, self.buckets)
        self._publish(loaded.schema, version, self.buckets, places, {}, after=self.snapshot() if self.exists() else None)
        return {**report, "rows_new": self.read().count()}

    @staticmethod
    def _rewritten(before: Snapshot, after: Snapshot) -> set[int] | None:
        """Buckets whose folder differs between two snapshots; None (any) when their numbers do not compare.

        An id is in the bucket of the same number in both, so the rows of all other buckets are the same.
        """
        if before.buckets != after.buckets or before.version != after.version:
            return None
        numbers = before.locations.keys() | after.locations.keys()
        return {b for b in numbers if before.locations.get(b) != after.locations.get(b)}

    def _loaded(self, snapshot: Snapshot, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
        """A snapshot's rows (of some buckets) by the declared schema, from its files: its catalog entry may be gone meanwhile."""
        held = [p for b, p in snapshot.locations.items() if only is None or b in only]
        reader = self.spark.read.schema(schema)
        return load_records(reader.parquet(*held) if held else self.spark.createDataFrame([], schema), self.declared)

    def _caught_up(self, places: dict[int, str], buckets: int, before: DataFrame, after: DataFrame) -> dict[int, str]:
        """Bucket folders of the copy after the writes between two snapshots, found by comparing rows."""
        same = F.xxhash64(*[F.col(f"`{c}`") for c in before.columns if c != self.row_id]).alias("__hash")
        known = before.select(self.row_id, same)
        changed = written(after.select("*", same).join(known, [self.row_id, "__hash"], "left_anti").drop("__hash"), "late")
        gone = written(before.select(self.row_id).join(after.select(self.row_id), self.row_id, "left_anti"), "gone")
        touched = changed.select(self.row_id).unionByName(gone)
        numbers = [r[0] for r in self._bucketed(touched, buckets).select(BUCKET).distinct().collect()]
        held = [places[b] for b in numbers if b in places]
        old = self.spark.read.schema(after.schema).parquet(*held) if held else after.limit(0)
        new = changes.upsert(changes.delete(old, gone, self.row_id), changed, self.row_id)
        return {**{b: p for b, p in places.items() if b not in numbers}, **self._write(new, buckets)}


def migrate_all(tables: list[tuple[VersionedTable, int]], rebuild: dict[str, DataFrame] | None = None) -> DataFrame:
    """Migrate every table; a failure is reported and does not stop the others.

    ``rebuild`` gives, by alias, the records a table is built anew from instead of being copied.
    """
    rows = []
    for table, version in tables:
        try:
            source = (rebuild or {}).get(table.alias)
            r = table.migrate(version) if source is None else table.rebuild(version, source)
        except Exception as error:  # reported per table
            r = {"table": table.alias, "code": f"ERROR: {type(error).__name__}", "rows_old": None, "rows_new": None, "hash_equal": False}
        rows.append((r["table"], r["code"], r["rows_old"], r["rows_new"], r["hash_equal"]))
    spark = tables[0][0].spark
    return spark.createDataFrame(rows, "table string, code string, rows_old long, rows_new long, hash_equal boolean")


def write_clustered(df: DataFrame, path: str, sort_by: list[str], files: int | None = None) -> None:
    """Write sorted by the given columns, cut by range, so scans can skip files and row groups."""
    ranged = df.repartitionByRange(files, *sort_by) if files else df.repartitionByRange(*sort_by)
    ranged.sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(path)
