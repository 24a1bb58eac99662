"""What the session provides: a shared folder for written tables, and size checks for broadcasts."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BROADCAST_BYTES = 32 << 20


_shipped: set[str] = set()
_stages: list[str] = []


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, qualified so that every process means the same place."""
    plain = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = plain.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(plain), files


def ship_package() -> None:
    """Send this package to the Python workers, once per application.

    The archive is put in the shared folder, from where Spark's own file distribution takes it.
    """
    session = SparkSession.getActiveSession()
    if session is None or session.sparkContext.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    place, files = hadoop_path(session, f"{new_path(session, 'package')}.zip")
    stream = files.create(place)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    session.sparkContext.addPyFile(place.toString())
    _shipped.add(session.sparkContext.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session without one gets a folder of its own."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tablelens-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """The frame as a written table: short lineage, computed once, safe against lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _stages.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged() -> list[str]:
    """Paths of the tables written on the way and not deleted yet."""
    return list(_stages)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of the tables written on the way."""
    for place in [p for p in paths if p in _stages]:
        _stages.remove(place)
        path, files = hadoop_path(spark, place)
        files.delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Delete the tables written on the way; frames built on them must be finished."""
    while _stages:
        path, files = hadoop_path(spark, _stages.pop())
        files.delete(path, True)


def measured_bytes(df: DataFrame) -> int:
    """Total size of the rows as JSON text, by one aggregate; an upper-side estimate of their size."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0]


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def join_sized(big: DataFrame, small: DataFrame, on, broadcast: bool, salts: int = 16) -> DataFrame:
    """Inner join with a usually small side whose size the caller has checked.

    When it is too large to broadcast, both sides shuffle with a salt, the small side once per
    salt, so that one hot key is spread over ``salts`` tasks.
    """
    on = [on] if isinstance(on, str) else list(on)
    if broadcast:
        return big.join(F.broadcast(small), on)
    others = [c for c in big.columns if c not in on] or on
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in others]), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = big.withColumn("__salt", salt).join(small.withColumn("__salt", copies), [*on, "__salt"])
    return salted.drop("__salt")
