import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.path.join(ROOT, "tests") + os.pathsep + os.environ.get("PYTHONPATH", "")
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoint')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TESTDATA}/sf0.001/{name}.parquet')")
    return con


def same_rows(frame, con, sql):
    """Sorted rows of both, columns by name."""
    columns = sorted(frame.columns)
    ours = sorted(str(tuple(r[c] for c in columns)) for r in frame.collect())
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    theirs = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
    return ours, theirs
