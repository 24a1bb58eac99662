import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def books(spark):
    """Three books with the properties the expected results rely on."""
    schema = """id string, title string, premise string, country string,
        categories array<struct<id:int,name:string>>, author string,
        publishing array<struct<author:string,organization:string,series:string,year:int,movieYear:int>>,
        heroes array<string>, price double, published_at timestamp, extra string"""
    rows = [
        (
            "1", "Harry Potter and the Sorcerer's Stone",
            "Raised by relatives, a young orphan learns he is a wizard and looks into his mysterious family.",
            "United Kingdom", [(101, "Fantasy"), (102, "School")], None,
            [("JKR", "Bloomsbury", "First book of the Harry Potter series", 1998, 2001)],
            ["Harry", "Hermione", "Ron"], 24.99, "1998-06-26", None,
        ),
        (
            "2", "Harry Potter and the Chamber of Secrets",
            "Back at school, a voice in the walls is a mystery that leads to a mysterious room.",
            "United Kingdom", [(101, "Fantasy")], None,
            [("JKR", "Bloomsbury", "Second book of the Harry Potter series", 1999, 2002)],
            ["Harry", "Hermione", "Ron"], 22.99, "1999-07-02", None,
        ),
        (
            "3", "Skyward",
            "One young pilot wants to defend her home against each alien attack.",
            "United States of America", [(101, "Fantasy"), (103, "Military")], None,
            [("BS", "Delacorte", "First book of the Skyward series", 2018, None)],
            ["Spensa"], 18.99, "2018-11-06", "data",
        ),
    ]
    import datetime

    rows = [(*r[:9], datetime.datetime.fromisoformat(r[9]), r[10]) for r in rows]
    return spark.createDataFrame(rows, schema)
