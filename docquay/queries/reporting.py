"""Counts per month and source, totals, failures and retries.

``orders`` serves as the log of one run: month and priority are the key, status F
is a failed document, P one that was found and never fetched. Every planned month
and priority is started; 1995 was planned with a source that returned nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docquay.operators import accounting, failures
from docquay.queries.inputs import ORDERS_SQL, orders, table

URL = "concat('http://h.example.org/d/', cast(o_custkey AS varchar(20)))"
CODE = "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 500 + o_custkey % 4 END"


def _plan(spark, sf):
    """All keys of the log but the urgent ones, and an idle source for each month."""
    keys = orders(spark, sf).select("partition", "body").where("body <> '1-URGENT'")
    return keys.unionByName(keys.select("partition", F.lit("Idle").alias("body"))).distinct()


_PLAN_SQL = f"""plan AS (SELECT DISTINCT "partition", body FROM {ORDERS_SQL} WHERE body <> '1-URGENT'
    UNION SELECT DISTINCT "partition", 'Idle' FROM {ORDERS_SQL} WHERE body <> '1-URGENT')"""


def _failures(spark, sf):
    failed = orders(spark, sf).where("o_orderstatus = 'F'").select(
        "partition", "body", F.expr(URL).alias("url"), F.expr(CODE).alias("status"),
        F.lit("timeout").alias("reason"),
    )
    return failures.classify_failures(failed).drop("status")


_FAILURES_SQL = f"""failed AS (SELECT "partition", body, {URL} AS url,
        CAST(coalesce({CODE}, 0) AS INTEGER) AS error_code,
        CASE WHEN {CODE} IS NULL THEN 'timeout' ELSE concat('HTTP ', {CODE}) END AS reason
    FROM {ORDERS_SQL} WHERE o_orderstatus = 'F')"""


def _counts(spark, sf):
    log = orders(spark, sf)
    one = F.lit(1)
    return accounting.key_counts(
        _plan(spark, sf),
        log.select("partition", "body", one.alias("records_found")),
        log.where("o_orderstatus = 'O'").select("partition", "body", one.alias("records_scraped")),
        log.where("o_orderstatus = 'F'").select("partition", "body", one.alias("records_failed")),
    )


_COUNTS_SQL = f"""{_PLAN_SQL}, counts AS (SELECT "partition", body, count(*) AS found,
        count(*) FILTER (o_orderstatus = 'O') AS scraped,
        count(*) FILTER (o_orderstatus = 'F') AS failed FROM {ORDERS_SQL} GROUP BY ALL),
    summary AS (SELECT "partition", body, coalesce(found, 0) AS records_found,
        coalesce(scraped, 0) AS records_scraped, coalesce(failed, 0) AS records_failed,
        coalesce(found - scraped - failed, 0) AS records_lost
        FROM plan LEFT JOIN counts USING ("partition", body))"""


def started_keys(spark, sf):
    return accounting.started_keys(_plan(spark, sf))


def found_count(spark, sf):
    return accounting.found_count(orders(spark, sf), F.lit(1))


def scraped_count(spark, sf):
    return accounting.scraped_count(orders(spark, sf).where("o_orderstatus <> 'F'"))


def failed_list(spark, sf):
    """Lists of about five different failures, as text."""
    lists = accounting.failed_list(_failures(spark, sf), chunk_rows=5)
    as_text = F.transform("failures", lambda f: F.format_string(
        "%s %d %s x%d", f["url"], f["error_code"], f["reason"], f["times"]))
    return lists.select(
        "partition", "body", "chunk", "records_failed", F.array_join(as_text, ", ").alias("failures")
    )


FAILED_LIST = f"""WITH {_FAILURES_SQL}, counted AS (SELECT "partition", body, url, error_code,
        reason, count(*) AS times FROM failed GROUP BY ALL),
    slotted AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY "partition", body) / 5.0) AS BIGINT)
        AS n_chunks, CAST('0x' || left(md5(concat_ws('|', url, error_code, reason)), 8) AS BIGINT)
        AS slot FROM counted)
    SELECT "partition", body, slot % n_chunks AS chunk, CAST(sum(times) AS BIGINT) AS records_failed,
        string_agg(concat(url, ' ', error_code, ' ', reason, ' x', times), ', '
            ORDER BY url, error_code, reason) AS failures FROM slotted GROUP BY ALL"""


def failed_count(spark, sf):
    return accounting.failed_count(_failures(spark, sf))


def partition_summary(spark, sf):
    return accounting.partition_summary(_counts(spark, sf))


def run_summary(spark, sf):
    return accounting.run_summary(_counts(spark, sf))


RUN_SUMMARY = f"""WITH {_COUNTS_SQL} SELECT count(*) AS partitions_processed,
        CAST(sum(records_found) AS BIGINT) AS total_records_found,
        CAST(sum(records_scraped) AS BIGINT) AS total_records_scraped,
        CAST(sum(records_failed) AS BIGINT) AS total_records_failed,
        (SELECT CAST(sum(failed) AS BIGINT) FROM counts WHERE ("partition", body) NOT IN
            (SELECT ("partition", body) FROM plan)) AS orphan_failures FROM summary"""


def transform_summary(spark, sf):
    outcome = F.expr("""CASE o_orderstatus WHEN 'F' THEN 'error' WHEN 'O' THEN 'transformed'
        ELSE 'skipped' END""")
    return accounting.transform_summary(orders(spark, sf).select(outcome.alias("outcome")))


TRANSFORM_SUMMARY = """SELECT count(*) AS total_records,
        count(*) FILTER (o_orderstatus = 'O') AS transformed,
        count(*) FILTER (o_orderstatus = 'P') AS skipped,
        count(*) FILTER (o_orderstatus = 'F') AS errors FROM orders"""


def failure_class(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    failed = table(spark, sf, "events").where("event_type = 'error'").select(
        "event_id",
        F.when(k >= 50, k + 450).alias("status"),
        F.concat(F.lit("error "), k.cast("string")).alias("reason"),
        F.when(F.col("value") > 10, F.date_format("ts", "yyyy-MM")).alias("partition"),
        F.when(F.col("user_id") > 50, F.col("user_id").cast("string")).alias("body"),
    )
    return failures.classify_failures(failed).drop("status")


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
FAILURE_CLASS = f"""SELECT event_id, CAST(CASE WHEN {_K} >= 50 THEN {_K} + 450 ELSE 0 END AS INTEGER)
            AS error_code,
        CASE WHEN {_K} >= 50 THEN concat('HTTP ', {_K} + 450) ELSE concat('error ', {_K}) END AS reason,
        CASE WHEN value > 10 THEN strftime(ts, '%Y-%m') ELSE 'unknown' END AS "partition",
        CASE WHEN user_id > 50 THEN CAST(user_id AS VARCHAR) ELSE 'unknown' END AS body
    FROM events WHERE event_type = 'error'"""

TRY_STATUS = """CASE event_type WHEN 'error' THEN 503 WHEN 'click' THEN 429 WHEN 'view' THEN 404
    WHEN 'signup' THEN NULL ELSE 200 END"""
TRY_URL = "concat('http://h.example.org/', cast(user_id AS varchar(9)), '/', cast(k AS varchar(9)))"


def retry_worklist(spark, sf):
    tries = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return failures.retry_worklist(tries.select(
        F.expr(TRY_URL).alias("url"), F.expr(TRY_STATUS).alias("status"),
        F.col("ts").alias("fetched_at"), "event_id",
    ), order=("fetched_at", "event_id"))


RETRY_WORKLIST = f"""WITH tries AS (SELECT {TRY_URL} AS url, {TRY_STATUS} AS status, ts, event_id
        FROM (SELECT *, {_K} AS k FROM events)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS rn,
        count(*) OVER (PARTITION BY url) - 1 AS retries FROM tries)
    SELECT url, status, retries FROM ranked
    WHERE rn = 1 AND status IN (500, 502, 503, 504, 408, 429) AND retries < 5"""


def plan_coverage(spark, sf):
    fetched = orders(spark, sf).where("o_orderstatus <> 'F'")
    return failures.plan_coverage(_plan(spark, sf), fetched, "partition", "body")


QUERIES = {
    "started_keys": (started_keys, f"WITH {_PLAN_SQL} SELECT * FROM plan"),
    "found_count": (found_count, f"""SELECT "partition", body, count(*) AS records_found
        FROM {ORDERS_SQL} GROUP BY ALL"""),
    "scraped_count": (scraped_count, f"""SELECT "partition", body, count(*) AS records_scraped
        FROM {ORDERS_SQL} WHERE o_orderstatus <> 'F' GROUP BY ALL"""),
    "failed_list": (failed_list, FAILED_LIST),
    "failed_count": (failed_count, f"""SELECT "partition", body, count(*) AS records_failed
        FROM {ORDERS_SQL} WHERE o_orderstatus = 'F' GROUP BY ALL"""),
    "partition_summary": (partition_summary, f"WITH {_COUNTS_SQL} SELECT * FROM summary"),
    "run_summary": (run_summary, RUN_SUMMARY),
    "transform_summary": (transform_summary, TRANSFORM_SUMMARY),
    "failure_class": (failure_class, FAILURE_CLASS),
    "retry_worklist": (retry_worklist, RETRY_WORKLIST),
    "plan_coverage": (plan_coverage, f"""WITH {_PLAN_SQL} SELECT * FROM plan
        WHERE ("partition", body) NOT IN (SELECT ("partition", body) FROM {ORDERS_SQL}
            WHERE o_orderstatus <> 'F')"""),
}
