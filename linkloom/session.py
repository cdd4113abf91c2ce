"""Session defaults and the two session helpers the iterative jobs need."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PARTITION = 50_000
MOST_ROWS_PER_PARTITION = 2_000_000
MAX_BROADCAST_ROWS = 1_000_000


def build_session(app: str = "linkloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; on a cluster leave ``master`` to spark-submit."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so the rows outlive the
    executors that made them. Only a local run without that setting gets a folder of its own.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="linkloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of :func:`checkpoint`, for tables that outlive the executors."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="linkloom-shared-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of a local run this package; a cluster gets it with ``--py-files``."""
    sc = spark.sparkContext
    if not sc.master.startswith("local") or getattr(sc, "_linkloom_shipped", False):
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="linkloom-package-")) / "linkloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in package.rglob("*.py"):
            archive.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._linkloom_shipped = True


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle width for ``rows`` rows: as many as the rows need, few when the data is small."""
    setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(rows / ROWS_PER_PARTITION)
    return max(1, min(wanted, setting), math.ceil(rows / MOST_ROWS_PER_PARTITION))


def hub_block_for(links: int, wanted: int) -> int:
    """Links per block of a hub: as wanted, or more where hubs would else outnumber a broadcast."""
    return max(wanted, math.ceil(links / MAX_BROADCAST_ROWS))


@contextmanager
def steady_plans(spark: SparkSession, width: int):
    """Plan the actions inside with a fixed shuffle width and without runtime re-planning.

    Tables laid out in ``width`` partitions by a key then meet in joins without another shuffle,
    and a checkpoint made inside keeps its partitioning and order, which adaptive plans hide.
    Use it where the layout already spreads hot keys.
    """
    fixed = {"spark.sql.shuffle.partitions": str(width), "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in fixed}
    for key, value in fixed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
