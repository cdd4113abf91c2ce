"""Limits are off unless a caller sets them, and shuffle widths follow the data."""

from linkloom.operators import frontier
from linkloom.plans import crawl
from linkloom.session import MOST_ROWS_PER_PARTITION, partitions_for


def test_no_limit_by_default(spark):
    found = spark.createDataFrame([(1, f"u{k}") for k in range(50)], "level int, url string")
    assert frontier.admit(10 ** 9, found).count() == 50
    rules = crawl.CrawlRules()
    assert rules.capacity is None and rules.required is None


def test_width_follows_the_rows(spark):
    assert partitions_for(spark, 0) == 1
    assert partitions_for(spark, 10 ** 12) == 10 ** 12 // MOST_ROWS_PER_PARTITION
