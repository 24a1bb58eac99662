import datetime

import pytest
from pyspark.sql import functions as F

from tablelens.sources import changes
from tablelens.sources.schema import (
    all_fields, drift, fulltext_fields, load_records, rejected_values, struct_type, with_properties,
)
from tablelens.sources.tables import VersionedTable, alias_name, migrate_all, table_name, write_clustered
from tablelens.streaming.jobs import file_stream, ingest, stream_histogram, stream_id

DECLARED = {"id": "keyword", "n": "integer", "note": "text"}


def make(spark, rows, columns="id string, n int, note string"):
    return spark.createDataFrame(rows, columns)


def content(df):
    return sorted((r["id"], r["n"], r["note"]) for r in df.collect())


@pytest.fixture()
def table(spark, request):
    t = VersionedTable(spark, "t_" + request.node.name.replace("[", "_").replace("]", ""), DECLARED, buckets=4)
    t.create(make(spark, [(str(i), i, f"note {i}") for i in range(20)]))
    return t


def test_upsert_touches_only_its_buckets(spark, table):
    before = table.snapshot()
    batch = make(spark, [("3", 30, "new"), ("99", 99, "added")])
    table.upsert(batch)
    after = table.snapshot()
    assert dict((r[0], r[1:]) for r in content(table.read()))["3"] == (30, "new")
    assert table.read().count() == 21
    same = [b for b in after.locations if after.locations[b] == before.locations.get(b)]
    assert 2 <= len(same) < 4
    first = content(table.read())
    table.upsert(batch)
    assert content(table.read()) == first


def test_last_of_a_batch_wins_and_missing_ids_are_drawn(spark, table):
    batch = make(spark, [("1", 5, "a", 1), ("1", 6, "b", 2), (None, 7, "c", 3)], "id string, n int, note string, seq int")
    table.upsert(batch, sequence="seq")
    rows = table.read().collect()
    assert table.read().columns == ["id", "n", "note"]
    assert [r["n"] for r in rows if r["id"] == "1"] == [6]
    drawn = [r["id"] for r in rows if r["n"] == 7 and r["note"] == "c"]
    assert len(drawn) == 1 and len(drawn[0]) == 36


def test_patch_delete_and_find(spark, table):
    unknown = table.patch(spark.createDataFrame([("2", "patched"), ("nope", "x")], "id string, note string"))
    assert [r[0] for r in unknown.collect()] == ["nope"]
    assert [tuple(r) for r in table.find_by_ids(["2"]).collect()] == [("2", 2, "patched")]
    table.delete(spark.createDataFrame([("2",), ("4",)], "id string"))
    assert table.read().count() == 18 and table.find_by_ids(["2", "5"]).count() == 1
    table.delete_all()
    assert table.read().count() == 0 and table.read().columns == ["id", "n", "note"]
    table.upsert(make(spark, [("a", 1, "back")]))
    assert content(table.read()) == [("a", 1, "back")]
    assert table.remove_unused_files() > 0 and content(table.read()) == [("a", 1, "back")]
    assert table.remove_unused_files() == 0


def test_new_columns_are_accepted(spark, table):
    table.upsert(spark.createDataFrame([("x", 1, "n", "more")], "id string, n int, note string, extra string"))
    assert table.read().filter("extra is not null").count() == 1 and table.read().count() == 21


def test_migrate(spark, table):
    wider = VersionedTable(spark, table.alias, {"id": "keyword", "n": "long", "note": "text", "tag": "keyword"}, buckets=8)
    assert {r["column"]: r["status"] for r in wider.status().collect()} == {
        "id": "same", "n": "retyped", "note": "same", "tag": "missing"}
    first = content(table.read())
    report = wider.migrate(2)
    assert report["code"] == "MIGRATED" and report["hash_equal"] and report["rows_new"] == 20
    assert content(wider.read()) == first and dict(wider.read().dtypes)["n"] == "bigint"
    assert wider.snapshot().table.startswith(table_name(table.alias, 2))
    assert wider.migrate(2)["code"] == "NO_CHANGE"


def test_writes_during_a_migration_are_kept(spark):
    declared = {"id": "keyword", "seq": "long"}
    t = VersionedTable(spark, "t_catch_up", declared, buckets=2)
    t.create(spark.createDataFrame([("a", 1), ("b", 2), ("d", 3)], "id string, seq long"))
    t.upsert(spark.createDataFrame([("a", 1)], "id string, seq long"), source="s", batch_id=4)

    class Busy(VersionedTable):
        def _write(self, df, buckets):
            places = super()._write(df, buckets)
            if not hasattr(self, "wrote"):
                self.wrote = True
                t.upsert(spark.createDataFrame([("b", 5), ("c", 6)], "id string, seq long"))
                t.delete(spark.createDataFrame([("d",)], "id string"))
            return places

    report = Busy(spark, "t_catch_up", declared, buckets=3).migrate(2)
    assert report["code"] == "MIGRATED" and report["hash_equal"] and report["rows_new"] == 3
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 1), ("b", 5), ("c", 6)]
    assert not t.upsert(spark.createDataFrame([("z", 9)], "id string, seq long"), source="s", batch_id=4)
    t.delete_all()
    assert not t.upsert(spark.createDataFrame([("z", 9)], "id string, seq long"), source="s", batch_id=3)


def test_catching_up_reads_only_rewritten_buckets(spark):
    declared = {"id": "keyword", "seq": "long"}
    t = VersionedTable(spark, "t_late_buckets", declared, buckets=8)
    t.create(spark.createDataFrame([(str(i), i) for i in range(100)], "id string, seq long"))
    first = t.snapshot()
    read = []

    class Busy(VersionedTable):
        def _write(self, df, buckets):
            places = super()._write(df, buckets)
            if not hasattr(self, "wrote"):
                self.wrote = True
                t.upsert(spark.createDataFrame([("7", 700)], "id string, seq long"))
                t.delete(spark.createDataFrame([("7",), ("9",)], "id string").limit(1))
                t.upsert(spark.createDataFrame([("7", 701)], "id string, seq long"))
            return places

        def _caught_up(self, places, buckets, before, after):
            read.append((len({f.rsplit("/", 1)[0] for f in before.inputFiles()}), len({f.rsplit("/", 1)[0] for f in after.inputFiles()})))
            return super()._caught_up(places, buckets, before, after)

    assert Busy(spark, "t_late_buckets", declared, buckets=8).migrate(2)["code"] == "MIGRATED"
    assert read == [(1, 1)] and len(first.locations) == 8
    assert sorted(tuple(r) for r in t.read().collect()) == sorted((str(i), 701 if i == 7 else i) for i in range(100))


def test_buckets_grow_with_a_migration(spark, table):
    before = content(table.read())
    most = table.stored_bytes(table.snapshot()) // 20
    grown = VersionedTable(spark, table.alias, DECLARED, buckets=4, bucket_bytes=most)
    assert grown.migrate(2)["code"] == "MIGRATED" and grown.snapshot().buckets == 32
    assert content(grown.read()) == before
    table.upsert(make(spark, [("3", 33, "later"), ("new", 1, "later")]))
    table.delete(make(spark, [("5", 0, "")]).select("id"))
    rows = {r["id"]: r["n"] for r in table.read().collect()}
    assert table.snapshot().buckets == 32 and rows["3"] == 33 and rows["new"] == 1 and "5" not in rows and len(rows) == 20
    assert [r["n"] for r in table.find_by_ids(["3"]).collect()] == [33]


def test_a_write_that_came_first_is_not_lost(spark, table):
    class Slow(VersionedTable):
        def _write(self, df, buckets):
            places = super()._write(df, buckets)
            if not hasattr(self, "waited"):
                self.waited = True
                table.upsert(make(spark, [("7", 70, "first")]))
            return places

    Slow(spark, table.alias, DECLARED, buckets=4).upsert(make(spark, [("7", 71, "second"), ("8", 80, "second")]))
    rows = {r["id"]: r["n"] for r in table.read().collect()}
    assert rows["7"] == 71 and rows["8"] == 80 and len(rows) == 20


def test_repeated_ids_need_a_sequence(spark, table):
    twice = make(spark, [("1", 5, "a"), ("1", 6, "b")])
    with pytest.raises(Exception, match="no sequence"):
        table.upsert(twice)
    with pytest.raises(Exception, match="no sequence"):
        changes.patch(table.read(), twice, "id").collect()
    lone = spark.createDataFrame([("1", 5, "a", None)], "id string, n int, note string, seq int")
    assert [r["n"] for r in changes.upsert(table.read(), lone, "id", "seq").filter("id = '1'").collect()] == [5]


def test_rebuild(spark, table):
    report = migrate_all([(table, 2)], {table.alias: make(spark, [("q", 1, "new")])}).head()
    assert (report["code"], report["rows_old"], report["rows_new"]) == ("REBUILT", 20, 1) and content(table.read()) == [("q", 1, "new")]


def test_status_without_a_table(spark):
    rows = VersionedTable(spark, "t_nowhere", DECLARED).status().collect()
    assert {r["column"]: r["status"] for r in rows} == {"id": "missing", "n": "missing", "note": "missing"}


def test_migrate_all_reports(spark):
    tables = [VersionedTable(spark, alias_name(n, prefix="staging"), DECLARED) for n in ("one", "two")]
    report = {r["table"]: r["code"] for r in migrate_all([(t, 1) for t in tables]).collect()}
    assert report == {"staging__english__one": "CREATED_INDEX", "staging__english__two": "CREATED_INDEX"}
    assert {r["code"] for r in migrate_all([(t, 1) for t in tables]).collect()} == {"NO_CHANGE"}


@pytest.mark.parametrize("name", ["", "-x", "Upper", "a~b", "x" * 256])
def test_bad_names(name):
    with pytest.raises(ValueError, match="Index name|table"):
        alias_name(name) if name else alias_name("-")


def test_schema():
    declared = {"title": "text", "user": {"email": "keyword", "bio": "text"}, "at": "date.epoch_second"}
    assert all_fields(declared) == ["title", "user.email", "user.bio", "at"]
    assert fulltext_fields(declared) == ["title", "user.bio"]
    assert struct_type(declared).simpleString() == (
        "struct<title:string,user:array<struct<email:string,bio:string>>,at:timestamp>"
    )
    assert with_properties(declared, {"title": "keyword"})["title"] == "keyword"


def test_load_and_rejects(spark):
    raw = spark.createDataFrame(
        [("1", "5", "0", ("a", "7")), ("2", "x", None, ("b", "y"))],
        "id string, n string, at string, user struct<name:string,age:string>",
    )
    declared = {"id": "keyword", "n": "integer", "at": "date.epoch_second", "user": {"name": "text", "age": "integer"}}
    rows = load_records(raw, declared).orderBy("id").collect()
    assert rows[0]["n"] == 5 and rows[1]["n"] is None and str(rows[0]["at"]) == "1970-01-01 00:00:00"
    assert rows[0]["user"][0]["age"] == 7 and rows[1]["user"][0]["age"] is None
    counts = {r["column"]: r["rejected"] for r in rejected_values(raw, declared).collect()}
    assert counts["n"] == 1 and counts["at"] == 0 and counts["user.age"] == 1
    assert {r["column"]: r["failing"] for r in drift(raw, declared).collect()}["n"] == 1


def test_clustered_write(spark, tmp_path):
    write_clustered(spark.range(1000).selectExpr("id", "id % 7 k"), str(tmp_path / "c"), ["k", "id"], 4)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000


def test_stream_ingest_is_idempotent(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    make(spark, [(str(i), i, "s") for i in range(10)]).coalesce(1).write.parquet(str(source / "rows.parquet"))
    t = VersionedTable(spark, "t_streamed", DECLARED, buckets=2)
    t.create()
    stream = spark.readStream.schema(t.read().schema).parquet(str(source / "rows.parquet"))
    ingest(stream, t, str(tmp_path / "cp"), "n").awaitTermination()
    assert t.read().count() == 10
    name = stream_id(spark, str(tmp_path / "cp"))
    assert not t.upsert(make(spark, [("zz", 0, "replayed")]), source=name, batch_id=0)
    other = stream.withColumn("id", F.concat("id", F.lit("b")))
    ingest(other, t, str(tmp_path / "cp2"), "n").awaitTermination()
    assert t.read().count() == 20


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_histogram(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check_stream_histogram(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def check_stream_histogram(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    q = stream_histogram(file_stream(spark, folder, "events"), "ts", "day", str(tmp_path / "h"), str(tmp_path / "cp"), "+02:00", view="v_days")
    q.awaitTermination()
    from tablelens.operators.aggregations import date_histogram

    batch = date_histogram(spark.read.parquet(f"{folder}/events.parquet"), "ts", "day", "+02:00")
    got = sorted(map(tuple, spark.table("v_days").collect()))
    assert got == sorted(map(tuple, batch.collect()))


def test_patch_to_null_and_unique_checks(spark):
    old = make(spark, [("1", 1, "a")])
    changed = changes.patch(old, spark.createDataFrame([("1", None)], "id string, n int"), "id", {"n": F.lit(True)})
    assert content(changed) == [("1", None, "a")]


def test_closed_calendar_buckets(spark, tmp_path):
    """A bucket comes once, after its end and the allowed delay; rows of a closed one are dropped; a restart goes on."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def batch(*times):
        rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
        rows.coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema("ts timestamp").parquet(folder)
        stream_histogram(stream, "ts", "month", out, str(tmp_path / "cp"), "+01:00", late="2 days", mode="append").awaitTermination()
        return {r.key: r["count"] for r in spark.read.schema("key string, bucket timestamp_ntz, count long").parquet(out).collect()}

    batch("2024-01-05 00:00:00", "2024-01-31 22:59:59", "2024-01-31 23:00:00", None)
    assert run() == {}
    batch("2024-02-01 12:00:00", "2024-01-30 12:00:00")  # late, but within the delay
    assert run() == {}
    batch("2024-02-03 12:00:00")
    assert run() == {"2024-01": 3}
    batch("2024-01-10 00:00:00", "2024-02-09 00:00:00")  # the first is too late
    assert run() == {"2024-01": 3}
    batch("2024-06-01 00:00:00")
    assert run() == {"2024-01": 3, "2024-02": 4}


def test_calendar_ends():
    from tablelens.streaming.jobs import _bucket_end

    def seconds(text):
        return int(datetime.datetime.fromisoformat(text + "+00:00").timestamp())

    assert _bucket_end(seconds("2024-02-01T00:00:00"), "month") == seconds("2024-03-01T00:00:00")
    assert _bucket_end(seconds("2023-10-01T00:00:00"), "quarter") == seconds("2024-01-01T00:00:00")
    assert _bucket_end(seconds("1968-01-01T00:00:00"), "year") == seconds("1969-01-01T00:00:00")
