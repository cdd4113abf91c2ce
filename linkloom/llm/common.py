"""What several operators share: tables, the shared folder, and Arrow batches as plain Python rows."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linkloom.session import ship_package

MAX_ID = (1 << 63) - 1
ROW_GROUP = 1 << 25


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share; only a local run without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="linkloom-shared-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, and safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores before it as make it differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def null_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("")))


#: What workers remember from task to task, by operator.
CACHES: list[dict] = []


def remembered() -> dict:
    """A table that lasts as long as its worker, or until another operator needs the memory."""
    CACHES.append({})
    return CACHES[-1]


def forget() -> None:
    for cache in CACHES:
        cache.clear()
    hand_back()


def hand_back() -> None:
    """Give freed memory back to the machine: a worker that a later task reuses starts small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, make: Callable, schema: str | T.StructType, max_rows: int = 1024) -> DataFrame:
    """``mapInArrow`` where ``make(batch)`` gives a dict of columns, or nothing, for a slice of at most ``max_rows`` rows."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, max_rows):
                columns = make(batch.slice(at, max_rows))
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(
                        [as_arrow(columns[f.name], f.type) for f in arrow], schema=arrow)
        hand_back()

    return df.mapInArrow(run, kinds)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
