"""Inputs that Spark derives from the given tables, and the same in SQL.

Expressions that both dialects share are written once and used on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquay.functions.markup import SPACE_CHARS
from docquay.sources.staging import staging_root
from docquay.sources.tables import load_table, spread

SEARCH_BASE = "http://search.example.org/en/search/"


def run_root(spark: SparkSession) -> str:
    """A new folder for the tables of a job, in the session's shared folder."""
    return f"{staging_root(spark)}/run-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"))


def with_container(html: str) -> str:
    """The page with its article as content container; the same in both dialects."""
    return (
        f"replace(replace({html}, '<article>', '<div class=\"content\">'),"
        " '</article>', '</div>')"
    )


# --- orders as collected documents: month, source, status -----------------------
ORDER_MONTH_SPARK = "date_format(o_orderdate, 'yyyy-MM')"
ORDER_MONTH_SQL = "strftime(o_orderdate, '%Y-%m')"


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.expr(ORDER_MONTH_SPARK).alias("partition"),
        F.col("o_orderpriority").alias("body"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
    )


ORDERS_SQL = f"""(SELECT {ORDER_MONTH_SQL} AS "partition", o_orderpriority AS body,
    o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders)"""

# --- pages as fetched documents ---------------------------------------------------
PAGE_BODY = "CASE WHEN url LIKE '%/en/%' THEN 'English' ELSE 'Other' END"
PAGE_MONTH = "concat('2024-', lpad(cast(1 + length(html) % 12 AS varchar(2)), 2, '0'))"
PAGE_STATUS = """CASE WHEN url LIKE '%/es/%' THEN 503 WHEN url LIKE '%/de/%' THEN NULL
    ELSE 200 END"""
PAGE_CONTENT_TYPE = """CASE WHEN url LIKE '%.html' THEN 'text/html; charset=utf-8'
    WHEN url LIKE '%page=2%' THEN 'Application/PDF'
    WHEN url LIKE '%utm_source%' THEN 'application/msword'
    WHEN url LIKE '%#top' THEN
        'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
    ELSE NULL END"""
PAGE_TYPE = """CASE WHEN url LIKE '%.html' THEN 'html' WHEN url LIKE '%page=2%' THEN 'pdf'
    WHEN url LIKE '%utm_source%' OR url LIKE '%#top' THEN 'doc' ELSE 'html' END"""


def page_fetches(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as answered document requests, some failed, of several content types."""
    identifier = "concat('PG-', cast(page_id AS varchar(20)))"
    return pages(spark, sf).select(
        F.expr(identifier).alias("identifier"),
        F.expr(identifier).alias("title"),
        F.expr("concat('Page ', url)").alias("description"),
        F.lit("17/07/2025").alias("published_date"),
        F.expr(identifier).alias("ref_no"),
        F.col("url").alias("doc_url"),
        F.expr(PAGE_BODY).alias("body"),
        F.expr(PAGE_MONTH).alias("partition_date"),
        F.lit(1).cast("bigint").alias("page"),
        F.lit(0).alias("position"),
        F.expr(PAGE_STATUS).alias("status"),
        F.expr("CASE WHEN url LIKE '%/de/%' THEN 'timeout' END").alias("reason"),
        F.expr(PAGE_CONTENT_TYPE).alias("content_type"),
        F.expr("cast(CASE WHEN url LIKE '%/en/%' THEN " + with_container("html")
               + " ELSE html END AS binary)").alias("content"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"),
        F.col("page_id").cast("string").alias("fetch_id"),
    )


PAGE_FETCHES_SQL = f"""fetches AS (
    SELECT page_id, url, concat('PG-', page_id) AS identifier, {PAGE_BODY} AS body,
        {PAGE_MONTH} AS partition_date, {PAGE_STATUS} AS status, {PAGE_TYPE} AS file_type,
        CASE WHEN url LIKE '%/en/%' THEN {with_container('html')} ELSE html END AS html
    FROM pages)"""

# --- SQL side of cleaning ------------------------------------------------------------
NOISE_RE = r"<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>"
NODE_RE = rf"(?is)(?:{NOISE_RE}|<[^>]*>)+"


def strip_re(html: str, regex: str, replacement: str = "") -> str:
    quoted = regex.replace("'", "''")
    return f"regexp_replace({html}, '(?is){quoted}', '{replacement}', 'g')"


def without_noise(html: str) -> str:
    return strip_re(html, NOISE_RE)


def decoded_sql(text: str) -> str:
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def visible_sql(html: str) -> str:
    node = decoded_sql("s")
    return (
        f"array_to_string(list_transform(regexp_split_to_array({html}, '{NODE_RE}'),"
        f" lambda s: trim({node}, '{SPACE_CHARS}')), '')"
    )


def container_sql(html: str) -> str:
    """Content of the derived container, which holds no inner div."""
    return (
        f"regexp_extract({without_noise(html)}, '(?is)<div class=\"content\">.*?</div>')"
    )


def without_chrome(html: str) -> str:
    html = without_noise(html)
    for tag in ("nav", "header", "footer"):
        html = strip_re(html, rf"<{tag}\b[^>]*>.*?</{tag}\s*>")
    return html


CLEAN_SQL = f"""CASE WHEN html LIKE '%class="content"%' THEN {container_sql('html')}
    ELSE {without_chrome('html')} END"""
STABLE_SQL = f"""CASE WHEN html LIKE '%class="content"%'
    THEN {visible_sql(container_sql('html'))} ELSE {visible_sql('html')} END"""
