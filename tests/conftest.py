import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from linkloom.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy(spark):
    """A→B, A→C, B→C, C→A, D→C, D→E."""
    return spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "C"), ("C", "A"), ("D", "C"), ("D", "E")],
                                 "src string, dst string")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(folder):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return base
