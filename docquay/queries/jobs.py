"""The jobs end to end on the pages table, in fresh folders of the shared staging area.

An earlier run landed everything but the ``.html`` addresses: pages with a query had
other text, all had other comments, French ones stood in another month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.functions import naming
from docquay.functions.dates import MONTH
from docquay.operators import state
from docquay.operators.extraction import CardLayout, Field
from docquay.plans import landing, reporting, transforming
from docquay.plans.schemas import EVENTS, QUARANTINE
from docquay.queries.inputs import (
    CLEAN_SQL,
    PAGE_BODY,
    PAGE_FETCHES_SQL,
    PAGE_MONTH,
    STABLE_SQL,
    page_fetches,
    pages,
    run_root,
    table,
)
from docquay.sources.event_log import event_counts, read_events, write_events
from docquay.sources.tables import (
    BATCH,
    DELETED,
    RunLog,
    append_batch,
    current_rows,
    read_batches,
    with_markers,
)
from docquay.streaming.landing import arriving_fetches, land_stream as run_stream

OLD_MONTH = "2023-12"


def _earlier(fetches):
    url = F.col("doc_url")
    old = F.when(F.contains(url, F.lit("?")), F.encode(F.lit("<p>old</p>"), "utf-8")).otherwise(
        F.encode(F.lit("<!-- old -->"), "utf-8")
    )
    return fetches.where(~url.endswith(".html")).withColumns({
        "content": F.concat("content", old),
        "partition_date": F.when(F.contains(url, F.lit("/fr/")), OLD_MONTH).otherwise(
            F.col("partition_date")
        ),
        "fetched_at": F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"),
    })


_metadata = landing.landed_records


def land(spark, sf):
    """Two runs; the stored records with what the second one did to them."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    second = landing.land(spark, fetches, root)
    return _metadata(spark, root).join(second.outcomes, "identifier")


_LANDED_SQL = f"""{PAGE_FETCHES_SQL}, landed AS (SELECT *, url NOT LIKE '%.html' AS in_first,
        concat(identifier, '.', file_type) AS file_name,
        CASE WHEN file_type = 'html' THEN sha256({STABLE_SQL}) ELSE sha256(html) END AS file_hash,
        url LIKE '%?%' OR file_type = 'doc' AS other_content FROM fetches WHERE status = 200),
    outcomes AS (SELECT *, CASE WHEN NOT in_first THEN 'inserted'
        WHEN other_content OR url LIKE '%/fr/%' THEN 'updated' ELSE 'unchanged' END AS outcome
        FROM landed)"""
_LANDING_COLUMNS = """identifier, identifier AS title, concat('Page ', url) AS description,
        '17/07/2025' AS published_date, identifier AS ref_no, url AS doc_url, body, partition_date,
        concat('landing-zone/', file_name) AS file_path, file_hash, file_type"""
LAND = f"WITH {_LANDED_SQL} SELECT {_LANDING_COLUMNS}, outcome FROM outcomes"


def landing_object_write(spark, sf):
    """Objects written by the two runs: the second writes new and changed ones only."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    landing.land(spark, fetches, root)
    written = spark.read.parquet(f"{root}/{landing.CONTENT}")
    index = landing.landed_index(spark, root).where(F.col(BATCH) == F.col("content_batch"))
    return written.join(index, ["file_name", BATCH]).select(
        "file_name", F.col(BATCH).cast("bigint").alias("run"), "content_type", "file_hash",
        F.length("content").cast("bigint").alias("n_bytes"),
    )


_MIME_SQL = """CASE file_type WHEN 'html' THEN 'text/html' WHEN 'pdf' THEN 'application/pdf'
    ELSE 'application/msword' END"""
_OLD_HTML = "html || CASE WHEN url LIKE '%?%' THEN '<p>old</p>' ELSE '<!-- old -->' END"
LANDING_OBJECT_WRITE = f"""WITH {_LANDED_SQL},
    earlier AS (SELECT file_name, file_type, url, {_OLD_HTML} AS html FROM landed WHERE in_first)
    SELECT file_name, CAST(1 AS BIGINT) AS run, {_MIME_SQL} AS content_type, file_hash,
        octet_length(encode(html)) AS n_bytes FROM landed WHERE NOT in_first OR other_content
    UNION ALL SELECT file_name, 0, {_MIME_SQL}, CASE WHEN file_type = 'html'
        THEN sha256({STABLE_SQL}) ELSE sha256(html) END, octet_length(encode(html)) FROM earlier"""


def landing_upsert(spark, sf):
    """Orders of each customer upserted by customer in two batches, months moving."""
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("identifier"),
        F.col("o_orderpriority").alias("title"),
        F.date_format("o_orderdate", MONTH).alias("partition_date"),
        "o_orderstatus", "o_orderdate", "o_orderkey",
    )
    root, fields = f"{run_root(spark)}/{landing.METADATA}", ("title", "partition_date")
    schema = with_markers(orders.select("identifier", *fields).schema)
    for batch, status in enumerate(("F", "O")):
        incoming = state.last_arrival(
            orders.where(F.col("o_orderstatus") == status), "identifier", "o_orderdate", "o_orderkey"
        )
        stored = current_rows(read_batches(spark, root, schema, range(batch)), "identifier")
        merged = state.upsert(stored, incoming, "identifier", fields, keep_untouched=False)
        changes = landing.metadata_changes(merged, stored)
        append_batch(changes, root, batch, "partition_date")
    rows = read_batches(spark, root, schema, range(2))
    moved = rows.where(DELETED).groupBy("identifier").agg(F.count(F.lit(1)).alias("n_moves"))
    return current_rows(rows, "identifier").join(moved, "identifier", "left")


LANDING_UPSERT = """WITH ranked AS (SELECT concat('C-', o_custkey) AS identifier,
        o_orderpriority AS title, strftime(o_orderdate, '%Y-%m') AS partition_date, o_orderstatus,
        row_number() OVER (PARTITION BY o_custkey, o_orderstatus
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
    f AS (SELECT * FROM ranked WHERE rn = 1 AND o_orderstatus = 'F'),
    o AS (SELECT * FROM ranked WHERE rn = 1 AND o_orderstatus = 'O')
    SELECT identifier, coalesce(o.title, f.title) AS title,
        coalesce(o.partition_date, f.partition_date) AS partition_date,
        CASE WHEN o.partition_date <> f.partition_date THEN 1 END AS n_moves
    FROM f FULL JOIN o USING (identifier)"""


def _two_transforms(spark, sf):
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    transforming.transform(spark, root, "2024-01-01", "2024-06-15")
    landing.land(spark, fetches, root)
    return root, transforming.transform(spark, root, "2024-01-01", "2024-12-31")


def transform(spark, sf):
    """Second transform run after a second landing: outcome and stored record of each."""
    root, run = _two_transforms(spark, sf)
    stored = transforming.transformed_rows(spark, root)
    return stored.join(run.outcomes.select("identifier", "outcome"), "identifier")


_TRANSFORMED_SQL = f"""{_LANDED_SQL}, done AS (SELECT *, in_first AND url NOT LIKE '%/fr/%'
        AND partition_date <= '2024-06' AS in_first_run,
        CASE WHEN file_type = 'html' THEN sha256({CLEAN_SQL}) ELSE sha256(html) END AS new_hash
        FROM landed)"""
TRANSFORM = f"""WITH {_TRANSFORMED_SQL} SELECT {_LANDING_COLUMNS}, file_hash AS source_hash,
        CASE WHEN in_first_run AND NOT other_content THEN 'skipped' ELSE 'transformed' END AS outcome
    FROM done"""
TRANSFORM = TRANSFORM.replace("'landing-zone/'", "'transformed-zone/'").replace(
    "file_path, file_hash, file_type", "file_path, new_hash AS file_hash, file_type"
)


def transform_changes(spark, sf):
    """Change runs after either landing; the second one only reads the second landing's rows."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    transforming.transform_changes(spark, root)
    landing.land(spark, fetches, root)
    run = transforming.transform_changes(spark, root)
    stored = transforming.transformed_rows(spark, root)
    return stored.join(run.outcomes.select("identifier", "outcome"), "identifier")


TRANSFORM_CHANGES = TRANSFORM.replace(f"WITH {_TRANSFORMED_SQL}", f"""WITH {_TRANSFORMED_SQL.replace(
    "SELECT *, in_first AND url NOT LIKE '%/fr/%'", "SELECT * REPLACE (CASE WHEN in_first AND NOT other_content"
    f" AND url LIKE '%/fr/%' THEN '{OLD_MONTH}' ELSE partition_date END AS partition_date), in_first"
).replace("AND partition_date <= '2024-06' AS in_first_run", "AS in_first_run")}""")


def transformed_object_write(spark, sf):
    """Content written by the second transform run: pending records only."""
    root, run = _two_transforms(spark, sf)
    written = spark.read.parquet(f"{root}/{transforming.CONTENT}/{BATCH}={run.batch}")
    index = spark.read.parquet(f"{root}/{transforming.INDEX}/{BATCH}={run.batch}")
    return written.join(index, "file_name").select(
        "file_name", "content_type", naming.content_hash(F.col("content")).alias("file_hash")
    )


TRANSFORM_REPORT = f"""WITH {_TRANSFORMED_SQL},
    marks AS (SELECT in_first_run AND NOT other_content AS skipped FROM done),
    n AS (SELECT count(*) AS total_records, count(*) FILTER (NOT skipped) AS transformed,
        count(*) FILTER (skipped) AS skipped FROM marks)
    SELECT CASE WHEN skipped THEN 'transform_skipped' ELSE 'transform_success' END AS event,
        count(*) AS n_events, CAST(NULL AS BIGINT) AS total_records, CAST(NULL AS BIGINT) AS transformed,
        CAST(NULL AS BIGINT) AS skipped, CAST(NULL AS BIGINT) AS errors FROM marks GROUP BY marks.skipped
    UNION ALL SELECT 'fetch_metadata', 1, NULL, NULL, NULL, NULL
    UNION ALL SELECT 'transform_summary', 1, total_records, transformed, skipped, 0 FROM n"""
TRANSFORMED_OBJECT_WRITE = f"""WITH {_TRANSFORMED_SQL} SELECT file_name,
        {_MIME_SQL} AS content_type, new_hash AS file_hash
    FROM done WHERE NOT (in_first_run AND NOT other_content)"""


def transformed_upsert(spark, sf):
    """Totals of the first and second transform run over the same months."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, fetches, root)
    runs = [transforming.transform(spark, root, "2024-02-01", "2024-11-30") for _ in range(2)]
    first, second = (
        run.summary.withColumn("run", F.lit(n)) for n, run in enumerate(runs, 1)
    )
    return first.unionByName(second)


TRANSFORMED_UPSERT = f"""WITH {_LANDED_SQL}, n AS (SELECT count(*) AS total_records FROM landed
        WHERE partition_date BETWEEN '2024-02' AND '2024-11')
    SELECT total_records, total_records AS transformed, CAST(0 AS BIGINT) AS skipped,
        CAST(0 AS BIGINT) AS errors, CAST(1 AS INTEGER) AS run FROM n UNION ALL
    SELECT total_records, 0, total_records, 0, 2 FROM n"""

REPORT_COLUMNS = (
    "event", "level", "partition", "body", "url", "error_code", "reason", "records_found",
    "records_scraped", "records_failed", "partitions_processed", "total_records_found",
    "total_records_scraped", "total_records_failed",
)


def _page_plan(spark, sf):
    """Months and sources of the result pages, an idle source for each month, and the pages."""
    key = (F.expr(PAGE_MONTH).alias("partition"), F.expr(PAGE_BODY).alias("body"))
    results = pages(spark, sf).select(*key, "html")
    months = results.select("partition").distinct()
    return results.select("partition", "body").unionByName(
        months.withColumn("body", F.lit("Idle"))
    ).distinct(), results


def _report_events(spark, sf):
    plan, results = _page_plan(spark, sf)
    items = landing.landing_items(page_fetches(spark, sf))
    counts = reporting.report_counts(plan, results, items, CardLayout(item=Field("li")))
    lines = reporting.report_events(
        counts, reporting.failures_of(items), "docs", F.lit("2024-07-01").cast("timestamp_ntz")
    )
    path = f"{run_root(spark)}/events"
    write_events(lines, path)
    return read_events(spark, path, EVENTS)


WHOLE_COLUMNS = (*REPORT_COLUMNS, "identifier", "outcome", "retries", "n_records")


def report_whole(spark, sf):
    """All events of the second landing run, written and read back, but for the lists of failures."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    landed = landing.land(spark, fetches, root)
    plan, results = _page_plan(spark, sf)
    lines = reporting.whole_report(
        plan, results, fetches, landed, "docs", F.lit("2024-07-01").cast("timestamp_ntz"),
        CardLayout(item=Field("li")),
    )
    write_events(lines, f"{root}/events")
    events = read_events(spark, f"{root}/events", EVENTS)
    return events.where("event <> 'partition_failures'").select(*WHOLE_COLUMNS)


def report(spark, sf):
    """Event log of a run, written and read back, but for the lists of failures."""
    return _report_events(spark, sf).where("event <> 'partition_failures'").select(*REPORT_COLUMNS)


def partition_failures(spark, sf):
    """The lists of failures in the event log, all chunks of a key together."""
    lists = _report_events(spark, sf).where("event = 'partition_failures'")
    return lists.select("partition", "body", F.inline("failures"))


PARTITION_FAILURES = f"""WITH {PAGE_FETCHES_SQL} SELECT partition_date AS "partition", body, url,
        CAST(coalesce(status, 0) AS INTEGER) AS error_code,
        CASE WHEN status IS NULL THEN 'timeout' ELSE 'HTTP 503' END AS reason, count(*) AS times
    FROM fetches WHERE status IS DISTINCT FROM 200 GROUP BY ALL"""


def landing_quarantine(spark, sf):
    """Fetches that a landing run did not store, each with its error."""
    root = run_root(spark)
    run = landing.land(spark, page_fetches(spark, sf), root)
    return read_batches(spark, f"{root}/{landing.QUARANTINE}", QUARANTINE, [run.batch]).drop(BATCH)


LANDING_QUARANTINE = f"""WITH {PAGE_FETCHES_SQL} SELECT identifier, url AS doc_url,
        partition_date AS "partition", body, CAST(coalesce(status, 0) AS INTEGER) AS error_code,
        CASE WHEN status IS NULL THEN 'timeout' ELSE 'HTTP 503' END AS error
    FROM fetches WHERE status IS DISTINCT FROM 200"""


def transform_report(spark, sf):
    """Events of a second transform run, written and read back, by kind."""
    root, run = _two_transforms(spark, sf)
    lines = reporting.transform_events(
        run.outcomes, run.summary, "2024-01-01", "2024-12-31", "docs",
        F.lit("2024-07-01").cast("timestamp_ntz"),
    )
    write_events(lines, f"{root}/events")
    events = read_events(spark, f"{root}/events", EVENTS)
    totals = events.groupBy("event").agg(
        F.max("total_records").alias("total_records"), F.max("transformed").alias("transformed"),
        F.max("skipped").alias("skipped"), F.max("errors").alias("errors"),
    )
    return event_counts(events).join(totals, "event")


REPORT = f"""WITH {PAGE_FETCHES_SQL}, cards AS (SELECT {PAGE_MONTH} AS "partition", {PAGE_BODY} AS body,
        len(regexp_extract_all(html, '<li>')) AS n FROM pages),
    plan AS (SELECT DISTINCT "partition", body FROM cards
        UNION SELECT DISTINCT "partition", 'Idle' FROM cards),
    found AS (SELECT "partition", body, CAST(sum(n) AS BIGINT) AS records_found FROM cards GROUP BY ALL),
    fetched AS (SELECT partition_date AS "partition", body,
        count(*) FILTER (status = 200) AS records_scraped,
        count(*) FILTER (status IS DISTINCT FROM 200) AS records_failed FROM fetches GROUP BY ALL),
    ends AS (SELECT "partition", body, coalesce(records_found, 0) AS records_found,
        coalesce(records_scraped, 0) AS records_scraped, coalesce(records_failed, 0) AS records_failed
        FROM plan LEFT JOIN found USING ("partition", body) LEFT JOIN fetched USING ("partition", body))
    SELECT 'partition_start' AS event, 'INFO' AS level, "partition", body, NULL AS url,
        CAST(NULL AS INTEGER) AS error_code, NULL AS reason, CAST(NULL AS BIGINT) AS records_found,
        CAST(NULL AS BIGINT) AS records_scraped, CAST(NULL AS BIGINT) AS records_failed,
        CAST(NULL AS BIGINT) AS partitions_processed, CAST(NULL AS BIGINT) AS total_records_found,
        CAST(NULL AS BIGINT) AS total_records_scraped, CAST(NULL AS BIGINT) AS total_records_failed
    FROM plan UNION ALL
    SELECT 'download_failed', 'WARNING', partition_date, body, url, coalesce(status, 0),
        CASE WHEN status IS NULL THEN 'timeout' ELSE 'HTTP 503' END,
        NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM fetches WHERE status IS DISTINCT FROM 200 UNION ALL
    SELECT 'partition_end', 'INFO', "partition", body, NULL, NULL, NULL, records_found,
        records_scraped, records_failed, NULL, NULL, NULL, NULL FROM ends UNION ALL
    SELECT 'run_summary', 'INFO', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*),
        CAST(sum(records_found) AS BIGINT), CAST(sum(records_scraped) AS BIGINT),
        CAST(sum(records_failed) AS BIGINT) FROM ends"""


_NO_MORE = "NULL AS identifier, NULL AS outcome, CAST(NULL AS BIGINT) AS retries, CAST(NULL AS BIGINT) AS n_records"


def _event_sql(event, level, **fields):
    """One kind of event: the columns of the whole report, null where not given."""
    texts = ("partition", "body", "url", "reason", "identifier", "outcome")
    columns = [f"'{event}' AS event", f"'{level}' AS level"]
    for c in WHOLE_COLUMNS[2:]:
        kind = "VARCHAR" if c in texts else "INTEGER" if c == "error_code" else "BIGINT"
        columns.append(f'CAST({fields.get(c, "NULL")} AS {kind}) AS "{c}"')
    return f"SELECT {', '.join(columns)}"


REPORT_WHOLE = f"""WITH {_LANDED_SQL}, shown AS ({REPORT}),
    stored AS (SELECT identifier, outcome FROM outcomes),
    kept AS (SELECT DISTINCT partition_date AS "partition", body FROM fetches WHERE status = 200),
    planned AS (SELECT DISTINCT {PAGE_MONTH} AS "partition", {PAGE_BODY} AS body FROM pages
        UNION SELECT DISTINCT {PAGE_MONTH}, 'Idle' FROM pages)
    SELECT *, {_NO_MORE} FROM shown
    UNION ALL BY NAME {_event_sql("record_stored", "INFO", identifier="identifier", outcome="outcome")} FROM stored
    UNION ALL BY NAME {_event_sql("upsert_summary", "INFO", outcome="outcome", n_records="count(*)")}
        FROM stored GROUP BY stored.outcome
    UNION ALL BY NAME {_event_sql("partition_uncovered", "WARNING", partition='"partition"', body="body")}
        FROM planned WHERE ("partition", body) NOT IN (SELECT ("partition", body) FROM kept)
    UNION ALL BY NAME {_event_sql("retry_planned", "WARNING", url="url", error_code="503", retries="count(*) - 1")}
        FROM fetches WHERE status = 503 GROUP BY fetches.url HAVING count(*) <= 5"""


def land_stream(spark, sf):
    """The fetches arriving as files, landed in several micro-batches."""
    root = run_root(spark)
    page_fetches(spark, sf).drop("fetch_id").repartition(8).write.parquet(f"{root}/arriving")
    stream = run_stream(
        arriving_fetches(spark, f"{root}/arriving", files_per_batch=4), root, f"{root}/checkpoint"
    )
    stream.awaitTermination()
    return _metadata(spark, root)


LAND_STREAM = f"WITH {_LANDED_SQL} SELECT {_LANDING_COLUMNS} FROM landed"

def transform_after_lost_run(spark, sf):
    """A landing run with other content that was lost before its commit, then a whole one."""
    root, fetches = run_root(spark), page_fetches(spark, sf)
    landing.land(spark, _earlier(fetches), root)
    lost = RunLog(spark, f"{root}/{landing.RUNS}").claim()
    other = fetches.withColumn("content", F.concat("content", F.encode(F.lit("<p>lost</p>"), "utf-8")))
    items = landing.landing_items(other)
    entries = landing.storable(items).select(
        "file_name", "file_hash", F.lit(lost).alias("content_batch"), *landing.ARRIVAL
    )
    append_batch(landing.object_content(other), f"{root}/{landing.CONTENT}", lost)
    append_batch(entries, f"{root}/{landing.INDEX}", lost)
    landing.land(spark, fetches, root)
    run = transforming.transform(spark, root, "2024-01-01", "2024-12-31")
    stored = transforming.transformed_rows(spark, root)
    return stored.join(run.outcomes.select("identifier", "outcome"), "identifier")


TRANSFORM_AFTER_LOST_RUN = TRANSFORM.replace(
    "CASE WHEN in_first_run AND NOT other_content THEN 'skipped' ELSE 'transformed' END", "'transformed'"
)


def _versions(spark, sf):
    """Documents as fetches, later ones of a source and language as its newer versions."""
    identifier = F.concat("source", F.lit("-"), "lang")
    fixed = {c: F.lit("x") for c in ("description", "published_date", "ref_no", "doc_url", "body")}
    return table(spark, sf, "documents").select(
        "doc_id", identifier.alias("identifier"), F.col("doc_id").cast("string").alias("title"),
        *[v.alias(c) for c, v in fixed.items()],
        F.expr("concat('2024-', lpad(cast(1 + n_chars % 12 AS string), 2, '0'))").alias("partition_date"),
        F.lit(1).cast("bigint").alias("page"), F.lit(0).alias("position"), F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("reason"), F.lit("application/pdf").alias("content_type"),
        F.col("text").cast("binary").alias("content"),
        F.expr("cast(timestamp_seconds(1704067200 + doc_id) AS timestamp_ntz)").alias("fetched_at"),
        F.col("doc_id").cast("string").alias("fetch_id"),
    )


def land_late(spark, sf):
    """Two runs, each with older and newer versions than the other."""
    root, versions = run_root(spark), _versions(spark, sf)
    landing.land(spark, versions.where("doc_id % 3 <> 0"), root)
    landing.land(spark, versions.where("doc_id % 3 = 0"), root)
    return landing.landed_records(spark, root).select("identifier", "title", "partition_date", "file_hash")


_LAST_SQL = """last AS (SELECT *, concat(source, '-', lang) AS identifier FROM documents QUALIFY row_number()
        OVER (PARTITION BY source, lang ORDER BY doc_id DESC) = 1)"""
LAND_LATE = f"""WITH {_LAST_SQL} SELECT identifier, CAST(doc_id AS VARCHAR) AS title,
        concat('2024-', lpad(CAST(1 + n_chars % 12 AS VARCHAR), 2, '0')) AS partition_date,
        sha256(text) AS file_hash FROM last"""


def land_interleaved(spark, sf):
    """Three runs and two compactions, each begun before the others are done, read month by month."""
    root, versions = run_root(spark), _versions(spark, sf)
    first = landing.LandingRun(spark, root)
    landing.land(spark, versions.where("doc_id % 3 = 0"), root)
    second = landing.LandingRun(spark, root)
    landing.compact(spark, root)
    first.write(versions.where("doc_id % 3 = 1"))
    second.write(versions.where("doc_id % 3 = 2"))
    first.commit()
    landing.compact(spark, root)
    second.commit()
    months = [f"2024-{m:02d}-01" for m in range(1, 13)]
    scans = [transforming.read_landed(spark, root, m, m) for m in months]
    return reduce(DataFrame.union, scans).select("identifier", "title", "partition_date", "file_hash")


def content_of_few(spark, sf):
    """Bytes of the toxic documents, from a store that a run of each language has added to."""
    root, docs = run_root(spark), table(spark, sf, "documents")
    own = _versions(spark, sf).withColumn("identifier", F.concat(F.lit("doc-"), "fetch_id"))
    own = own.join(docs.select("doc_id", "lang"), "doc_id")
    for (lang,) in docs.select("lang").distinct().orderBy("lang").collect():
        landing.land(spark, own.where(F.col("lang").eqNullSafe(F.lit(lang))).drop("lang"), root)
    toxic = table(spark, sf, "labels").where("toxic = 1").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file_name")
    ).distinct()
    index = landing.current_objects(landing.landed_index(spark, root))
    content = landing.content_of(spark, root, index.join(toxic, "file_name").select("file_name", "content_batch"))
    return content.select(
        "file_name", F.length("content").cast("bigint").alias("n_bytes"),
        naming.content_hash(F.col("content")).alias("file_hash"),
    )


CONTENT_OF_FEW = """SELECT concat('doc-', doc_id, '.pdf') AS file_name, octet_length(encode(text)) AS n_bytes,
        sha256(text) AS file_hash
    FROM documents WHERE text <> '' AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"""


def land_stream_late(spark, sf):
    """A batch run first, then a stream over shuffled files behind a new checkpoint."""
    root, versions = run_root(spark), _versions(spark, sf)
    landing.land(spark, versions.where("doc_id % 3 = 1"), root)
    arriving = versions.where("doc_id % 3 <> 1").drop("fetch_id", "doc_id")
    arriving.repartition(4, "title").write.parquet(f"{root}/arriving")
    stream = run_stream(
        arriving_fetches(spark, f"{root}/arriving", files_per_batch=2), root, f"{root}/checkpoint"
    )
    stream.awaitTermination()
    return landing.landed_records(spark, root).select("identifier", "title", "partition_date", "file_hash")


def landing_compact(spark, sf):
    """Objects of two runs after compaction, when all that is superseded is gone."""
    root, versions = run_root(spark), _versions(spark, sf)
    landing.land(spark, versions.where("doc_id % 3 <> 0"), root)
    landing.land(spark, versions.where("doc_id % 3 = 0"), root)
    landing.compact(spark, root, move_content=True)
    landing.remove_superseded(spark, root)
    index = landing.current_objects(landing.landed_index(spark, root))
    content = landing.content_of(spark, root, index)
    return content.select(
        "file_name", F.length("content").cast("bigint").alias("n_bytes"),
        naming.content_hash(F.col("content")).alias("file_hash"),
    )


LANDING_COMPACT = f"""WITH {_LAST_SQL} SELECT concat(identifier, '.pdf') AS file_name,
        octet_length(encode(text)) AS n_bytes, sha256(text) AS file_hash FROM last"""

QUERIES = {
    "partition_failures": (partition_failures, PARTITION_FAILURES),
    "landing_quarantine": (landing_quarantine, LANDING_QUARANTINE),
    "transform_report": (transform_report, TRANSFORM_REPORT),
    "transform_after_lost_run": (transform_after_lost_run, TRANSFORM_AFTER_LOST_RUN),
    "land_late": (land_late, LAND_LATE),
    "land_interleaved": (land_interleaved, LAND_LATE),
    "transform_changes": (transform_changes, TRANSFORM_CHANGES),
    "land_stream_late": (land_stream_late, LAND_LATE),
    "content_of_few": (content_of_few, CONTENT_OF_FEW),
    "landing_compact": (landing_compact, LANDING_COMPACT),
    "land": (land, LAND),
    "landing_object_write": (landing_object_write, LANDING_OBJECT_WRITE),
    "landing_upsert": (landing_upsert, LANDING_UPSERT),
    "transform": (transform, TRANSFORM),
    "transformed_object_write": (transformed_object_write, TRANSFORMED_OBJECT_WRITE),
    "transformed_upsert": (transformed_upsert, TRANSFORMED_UPSERT),
    "report": (report, REPORT),
    "report_whole": (report_whole, REPORT_WHOLE),
    "land_stream": (land_stream, LAND_STREAM),
}
