"""Typed loading, table writes and migration, on tables derived from the given ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablelens.plans.runtime import new_path
from tablelens.queries import query
from tablelens.sources import changes
from tablelens.sources.reader import read_table
from tablelens.sources.schema import drift, load_records, rejected_values, union_open
from tablelens.sources.tables import VersionedTable, migrate_all, write_clustered

CUSTOMER = {
    "c_custkey": "long", "c_name": "text", "c_nationkey": "integer", "c_acctbal": "double", "c_mktsegment": "keyword",
}


def customers(spark, d):
    return read_table(spark, d, "customer")


def stored(spark, d, declared=CUSTOMER, buckets=8) -> VersionedTable:
    table = VersionedTable(spark, f"customer_{uuid.uuid4().hex}", declared, "c_custkey", buckets)
    table.create(customers(spark, d))
    return table


@query("scan_alias", "SELECT * FROM customer")
def _(spark, d):
    return stored(spark, d).read()


def raw_customers(spark, d):
    """Customers as text records, some with values that do not convert."""
    return customers(spark, d).select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.when(F.col("c_nationkey") == 7, "seven").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )


@query(
    "typed_load",
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
)
def _(spark, d):
    return load_records(raw_customers(spark, d), CUSTOMER)


@query(
    "rejected_values",
    """SELECT 'c_custkey' AS "column", 0::BIGINT AS rejected UNION ALL SELECT 'c_name', 0
       UNION ALL SELECT 'c_nationkey', count(*) FILTER (c_nationkey = 7) FROM customer
       UNION ALL SELECT 'c_acctbal', count(*) FILTER (c_mktsegment = 'MACHINERY') FROM customer
       UNION ALL SELECT 'c_mktsegment', 0""",
)
def _(spark, d):
    return rejected_values(raw_customers(spark, d), CUSTOMER)


@query(
    "schema_drift",
    """SELECT 'c_custkey' AS "column", 'retyped' AS status, 0::BIGINT AS failing UNION ALL SELECT 'c_name', 'same', 0
       UNION ALL SELECT 'c_nationkey', 'retyped', count(*) FILTER (c_nationkey = 7) FROM customer
       UNION ALL SELECT 'c_acctbal', 'retyped', count(*) FILTER (c_mktsegment = 'MACHINERY') FROM customer
       UNION ALL SELECT 'c_since', 'missing', 0 UNION ALL SELECT 'c_mktsegment', 'extra', 0""",
)
def _(spark, d):
    declared = {k: v for k, v in CUSTOMER.items() if k != "c_mktsegment"} | {"c_since": "date"}
    return drift(raw_customers(spark, d), declared).select("column", "status", "failing")


def batch(spark, d):
    """Two versions of every BUILDING customer, and a new customer for every AUTOMOBILE one."""
    base = customers(spark, d)
    changed = base.filter("c_mktsegment = 'BUILDING'")
    first = changed.withColumn("c_acctbal", F.lit(-1.0)).withColumn("seq", F.lit(1))
    second = changed.withColumn("c_acctbal", F.col("c_acctbal") + 100).withColumn("seq", F.lit(2))
    added = base.filter("c_mktsegment = 'AUTOMOBILE'").withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    return union_open([first, second, added.withColumn("seq", F.lit(1))])


UPSERTED = """SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
  UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_mktsegment = 'AUTOMOBILE'"""


@query("upsert", UPSERTED)
def _(spark, d):
    return changes.upsert(customers(spark, d), batch(spark, d), "c_custkey", "seq")


@query("upsert_stored", UPSERTED)
def _(spark, d):
    table = stored(spark, d)
    table.upsert(batch(spark, d), "seq")
    return table.read()


@query(
    "patch",
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment FROM customer""",
)
def _(spark, d):
    new = customers(spark, d).filter("c_nationkey = 3").select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit(None).cast("string").alias("c_name")
    )
    return changes.patch(customers(spark, d), new, "c_custkey")


@query("patch_unknown_ids", "SELECT c_custkey + 10000000 AS c_custkey FROM customer WHERE c_nationkey = 3")
def _(spark, d):
    known = customers(spark, d).filter("c_nationkey = 3").select("c_custkey", "c_acctbal")
    strange = known.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    return changes.unknown_ids(customers(spark, d), known.unionByName(strange), "c_custkey")


@query("delete_by_ids", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(spark, d):
    keys = read_table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return changes.delete(customers(spark, d), keys, "c_custkey")


@query("delete_all", "SELECT * FROM customer WHERE false")
def _(spark, d):
    table = stored(spark, d)
    table.delete_all()
    return table.read()


@query("find_by_ids", "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def _(spark, d):
    keys = read_table(spark, d, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return changes.find_by_ids(customers(spark, d), keys, "c_custkey")


@query("clustered_write", "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def _(spark, d):
    path = new_path(spark, "clustered")
    write_clustered(read_table(spark, d, "orders"), path, ["o_orderdate", "o_orderkey"], 8)
    return spark.read.parquet(path).filter(F.col("o_orderdate").between("1997-01-01", "1997-06-30"))


NEXT_CUSTOMER = {**CUSTOMER, "c_nationkey": "long", "c_rank": "integer"}


@query(
    "migrate",
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment, NULL::INT AS c_rank FROM customer""",
)
def _(spark, d):
    old = stored(spark, d)
    new = VersionedTable(spark, old.alias, NEXT_CUSTOMER, "c_custkey", 16)
    report = new.migrate(2)
    if report["code"] != "MIGRATED":
        raise RuntimeError(f"migration failed: {report}")
    return new.read()


class WrittenMeanwhile(VersionedTable):
    """A table into which ``meanwhile`` writes after the first copy of a migration."""

    meanwhile = None

    def _write(self, df, buckets):
        places = super()._write(df, buckets)
        if self.meanwhile:
            write, self.meanwhile = self.meanwhile, None
            write()
        return places


@query(
    "migrate_catch_up",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey AS seq FROM orders""",
)
def _(spark, d):
    """Rows added to the old version after its copy began reach the new one."""
    declared = {"o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "keyword", "seq": "long"}
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderkey").alias("seq"))
    half = rows.agg(F.floor(F.max("seq") / 2)).head()[0]
    old = VersionedTable(spark, f"orders_{uuid.uuid4().hex}", declared, "o_orderkey", 8)
    old.create(rows.filter(F.col("seq") <= half))
    new = WrittenMeanwhile(spark, old.alias, declared, "o_orderkey", 8)
    new.meanwhile = lambda: old.upsert(rows.filter(F.col("seq") > half), "seq")
    new.migrate(2)
    return new.read()


@query(
    "migrate_during_writes",
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, CASE WHEN c_nationkey = 5 THEN -1.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment, NULL::INT AS c_rank FROM customer WHERE c_nationkey <> 9
       UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey::BIGINT, c_acctbal, c_mktsegment, NULL FROM customer WHERE c_nationkey = 5""",
)
def _(spark, d):
    """Changed, added and deleted rows while a migration copies."""
    old, some = stored(spark, d), customers(spark, d).filter("c_nationkey = 5")

    def write():
        old.upsert(some.withColumn("c_acctbal", F.lit(-1.0)))
        old.upsert(some.withColumn("c_custkey", F.col("c_custkey") + 10_000_000))
        old.delete(customers(spark, d).filter("c_nationkey = 9").select("c_custkey"))

    new = WrittenMeanwhile(spark, old.alias, NEXT_CUSTOMER, "c_custkey", 16)
    new.meanwhile = write
    report = new.migrate(2)
    if report["code"] != "MIGRATED":
        raise RuntimeError(f"migration failed: {report}")
    return new.read()


@query(
    "patch_repeated_id",
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 3 THEN 2.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
)
def _(spark, d):
    """Two changes of each record: the later one counts, and no row is doubled."""
    some = customers(spark, d).filter("c_nationkey = 3")
    changed = [some.select("c_custkey", F.lit(v).alias("c_acctbal"), F.lit(n).alias("seq")) for v, n in ((2.0, 2), (1.0, 1))]
    return changes.patch(customers(spark, d), union_open(changed), "c_custkey", sequence="seq")


@query("upsert_null_sequence", "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 4 THEN 7.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer")
def _(spark, d):
    """Records without a sequence are written whole, and come before those that have one."""
    some = customers(spark, d).filter("c_nationkey = 4")
    first = some.withColumn("c_acctbal", F.when(F.col("c_custkey") % 2 == 0, 1.0).otherwise(7.0)).withColumn("seq", F.lit(None).cast("int"))
    second = some.filter("c_custkey % 2 = 0").withColumn("c_acctbal", F.lit(7.0)).withColumn("seq", F.lit(0))
    return changes.upsert(customers(spark, d), union_open([first, second]), "c_custkey", "seq")


@query(
    "patch_stored",
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment FROM customer""",
)
def _(spark, d):
    table = stored(spark, d)
    table.patch(customers(spark, d).filter("c_nationkey = 3").select("c_custkey", F.lit(0.0).alias("c_acctbal")))
    return table.read()


@query("delete_stored", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(spark, d):
    table = stored(spark, d)
    keys = read_table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    table.delete(keys)
    return table.read()


@query(
    "migrate_many",
    """SELECT 'MIGRATED' AS code, count(*) AS rows_old, count(*) AS rows_new, true AS hash_equal FROM customer
       UNION ALL SELECT 'NO_CHANGE', count(*), count(*), true FROM customer
       UNION ALL SELECT 'CREATED_INDEX', 0, 0, true""",
)
def _(spark, d):
    first, second = stored(spark, d), stored(spark, d)
    moved = VersionedTable(spark, first.alias, NEXT_CUSTOMER, "c_custkey", 8)
    fresh = VersionedTable(spark, f"customer_{uuid.uuid4().hex}", CUSTOMER, "c_custkey", 8)
    return migrate_all([(moved, 2), (second, 1), (fresh, 1)]).drop("table")
