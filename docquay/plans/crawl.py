"""Crawl plan: which searches to send for a date range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquay.functions.dates import month_windows, parse_bounds
from docquay.functions.urls import search_url

PAGES_PER_BLOCK = 1000


def month_partitions(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month: ``from_date``, ``to_date`` (d/m/yyyy) and ``partition``."""
    first, last = parse_bounds(start, end)
    return spark.range(1).select(
        F.inline(month_windows(F.lit(first), F.lit(last)))
    )


def crawl_plan(
    sources: DataFrame, start: Column, end: Column, search_base: str
) -> DataFrame:
    """First search of every month and source.

    Each source row generates its own months, so there is no join and the number
    of sources may grow freely. Order by ``partition`` for the month-major order.
    """
    ranged = sources.select("body", "body_id", start.alias("start"), end.alias("end"))
    windows = month_windows(F.col("start"), F.col("end"))
    months = ranged.select("body", "body_id", F.inline(windows))
    return _with_url(months.withColumn("page", F.lit(1).cast("bigint")), search_base)


def _with_url(plan: DataFrame, search_base: str) -> DataFrame:
    url = search_url(search_base, *[F.col(c) for c in ("from_date", "to_date", "body_id", "page")])
    columns = ("partition", "from_date", "to_date", "body", "body_id", "page")
    return plan.select(*columns, url.alias("url"))


def page_expansion(first_pages: DataFrame, search_base: str) -> DataFrame:
    """Searches for page 2 to the last, of first pages that have cards.

    ``first_pages`` is a plan with ``n_cards`` and ``n_pages``. Pages are generated
    in blocks, so that no array grows with the number of results.
    """
    last = F.when((F.col("n_cards") > 0) & (F.col("n_pages") >= 2), F.col("n_pages"))
    size = F.lit(PAGES_PER_BLOCK).cast("bigint")
    starts = F.sequence(F.lit(2).cast("bigint"), F.col("last"), size)
    block = F.sequence(F.col("block"), F.least(F.col("block") + size - 1, F.col("last")))
    pages = (
        first_pages.withColumn("last", last)
        .where(F.col("last").isNotNull())
        .withColumn("block", F.explode(starts))
        .withColumn("page", F.explode(block))
    )
    return _with_url(pages, search_base)


def full_plan(plan: DataFrame, first_pages: DataFrame, search_base: str) -> DataFrame:
    """First and following searches; duplicates are allowed and kept."""
    return plan.unionByName(page_expansion(first_pages, search_base))
