import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def same(spark, duck, query, sql, data=DATA):
    """Columns and rows of a query are those of its SQL, in any order."""
    df = query(spark, data)
    columns = sorted(df.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    assert columns == sorted(r[0] for r in duck.execute(f"DESCRIBE SELECT * FROM ({sql}) x").fetchall())
    key = lambda row: tuple((v is None, str(v)) for v in row)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    assert ours == sorted(map(tuple, duck.execute(f"SELECT {names} FROM ({sql}) x").fetchall()), key=key)
    return ours
