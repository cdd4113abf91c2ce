"""Captured pages laid out once for many lookups: bucketed and sorted by canonical URL, beside a narrow table of URLs.

A wave of a crawl joins its batch with the narrow table, and of the pages it reads only the buckets this names and,
within them, only the row groups whose URLs lie in the batch's range. One page is kept for a URL, its first capture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import MAX_BROADCAST_ROWS, checkpoint

PAGES_PER_BUCKET = 20_000
MOST_BUCKETS = 4096
WRITERS = 4


class PageStore:
    """Pages ``url, capture, html`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names = spark.read.parquet(f"{path}/names")  # url, capture, bucket
        kind = self.names.schema["capture"].dataType.simpleString()
        self.schema = f"url string, capture {kind}, html string, bucket int"

    @classmethod
    def write(cls, pages: DataFrame, path: str, buckets: int | None = None) -> PageStore:
        """Store ``url, capture, html`` as :func:`crawl.captured` gives them; the names come last, and tell that the
        store is whole. The writers of a bucket share its URLs."""
        first = checkpoint(pages.groupBy("url").agg(F.min("capture").alias("capture")))
        if buckets is None:
            buckets = min(MOST_BUCKETS, max(1, -(-first.count() // PAGES_PER_BUCKET)))
        bucket = F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int")
        writer = F.pmod(F.xxhash64(F.reverse("url")), F.lit(WRITERS))
        rows = pages.join(first, ["url", "capture"]).dropDuplicates(["url"]).withColumn("bucket", bucket)
        rows.repartition(buckets * WRITERS, "bucket", writer).sortWithinPartitions("bucket", "url").write.partitionBy(
            "bucket").parquet(f"{path}/pages")
        first.withColumn("bucket", bucket).write.parquet(f"{path}/names")
        return cls(pages.sparkSession, path)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows of ``wanted`` whose ``url`` is stored, with ``capture`` and ``html``."""
        known = checkpoint(wanted.join(self.names.select("url", "bucket"), "url"))
        # one row a bucket, and no more than MOST_BUCKETS
        named = known.groupBy("bucket").agg(F.count("*").alias("n"), F.min("url").alias("least"), F.max("url").alias("most")).collect()
        pages = self.spark.read.schema(self.schema).parquet(f"{self.path}/pages").filter(F.col("bucket").isin([r.bucket for r in named]))
        if named:
            pages = pages.filter(F.col("url").between(min(r.least for r in named), max(r.most for r in named)))
        small = sum(r.n for r in named) <= MAX_BROADCAST_ROWS
        return pages.join(F.broadcast(known) if small else known, ["bucket", "url"]).drop("bucket")
