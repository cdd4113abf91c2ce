"""Column-store tables: the captured pages, the document tables, the stored index, and derived graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a table stored in fewer pieces than there are cores, dealt over all cores; any other table as it is.

    For texts, whose analysis costs far more than moving them; a table large enough has more pieces than cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def scan_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Captured pages ``page_id, url, html``."""
    return spread(read_table(spark, folder, "pages").select("page_id", "url", "html"))


def index_graph_scan(index: DataFrame) -> DataFrame:
    """``doc_id, n_in, n_out, author, is_sink`` of index documents, without their text.

    The lists of a hub come in several rows, so their sizes are summed: a page is a sink only if no row has outlinks.
    """
    sizes = index.select("doc_id", "author", F.size("inlinks").alias("n_in"), F.size("outlinks").alias("n_out"))
    summed = sizes.groupBy("doc_id", "author").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    return summed.withColumn("is_sink", F.col("n_out") == 0)


def part_pairs(spark: SparkSession, folder: str, suppliers: bool = False) -> DataFrame:
    """A link for every two parts that follow each other in an order.

    ``suppliers`` adds a link from each part to its supplier, under the supplier's negative key. Suppliers link
    to nothing, so they are sinks. An order has no more than a handful of lines, so its window is small.
    """
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    pairs = lines.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(in_order).alias("dst"))
    pairs = pairs.filter("dst is not null")
    if suppliers:
        pairs = pairs.unionByName(lines.select(F.col("l_partkey").alias("src"), (-F.col("l_suppkey")).alias("dst")))
    return pairs


def part_graph(spark: SparkSession, folder: str, suppliers: bool = False) -> DataFrame:
    """The distinct links of :func:`part_pairs`."""
    return part_pairs(spark, folder, suppliers).distinct()
