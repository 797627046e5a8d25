"""Object store, change detection, upsert and incremental state.

``documents`` is the corpus. The stored state is what an earlier run would have
left: all languages but German, French texts in an older version. The incoming
rows are everything but Spanish. So all outcomes occur over the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docquay.functions import naming
from docquay.operators import accounting, failures, state
from docquay.plans import landing
from docquay.plans.schemas import LANDING_FIELDS, TRANSFORMED_FIELDS
from docquay.plans.transforming import NOT_FOUND, mark_skipped, record_error, transformed_records
from docquay.queries.inputs import PAGE_BODY, page_fetches, pages, run_root, table, with_container

FIELDS = ("title", "file_hash")
OLD_TEXT = "CASE WHEN lang = 'fr' THEN concat(text, '!') ELSE text END"


def _document(text: str):
    return (
        F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")).alias("identifier"),
        F.col("source").alias("title"),
        F.sha2(F.expr(text).cast("binary"), 256).alias("file_hash"),
    )


def _stored(spark, sf):
    docs = table(spark, sf, "documents").where("lang <> 'de'")
    return docs.select(*_document(OLD_TEXT), F.col("lang").alias("note"))


def _incoming(spark, sf):
    return table(spark, sf, "documents").where("lang <> 'es'").select(*_document("text"))


_STATE_SQL = f"""stored AS (SELECT concat('DOC-', doc_id) AS identifier, source AS title,
        sha256({OLD_TEXT}) AS file_hash, lang AS note FROM documents WHERE lang <> 'de'),
    incoming AS (SELECT concat('DOC-', doc_id) AS identifier, source AS title,
        sha256(text) AS file_hash FROM documents WHERE lang <> 'es'),
    merged AS (SELECT identifier, coalesce(i.title, s.title) AS title,
        coalesce(i.file_hash, s.file_hash) AS file_hash, note,
        CASE WHEN i.title IS NULL THEN 'kept' WHEN s.title IS NULL THEN 'inserted'
            WHEN i.file_hash = s.file_hash THEN 'unchanged' ELSE 'updated' END AS outcome
        FROM stored s FULL JOIN incoming i USING (identifier))"""


def _merged(spark, sf):
    return state.upsert(_stored(spark, sf), _incoming(spark, sf), "identifier", FIELDS)


def upsert_summary(spark, sf):
    return accounting.upsert_summary(_merged(spark, sf))


def last_arrival(spark, sf):
    """Many versions per key, very uneven: documents of one source and language."""
    versions = table(spark, sf, "documents").select(
        F.concat("source", F.lit("-"), "lang").alias("identifier"), "n_chars", "doc_id"
    )
    return state.last_arrival(versions, "identifier", "n_chars", "doc_id")


def changed_objects(spark, sf):
    named = [naming.object_name(F.col("identifier"), F.lit("html")).alias("file_name"), "file_hash"]
    return state.changed_objects(
        _incoming(spark, sf).select(*named), _stored(spark, sf).select(*named)
    )


def unique_key_check(spark, sf):
    text_hash = F.sha2(F.col("text").cast("binary"), 256).alias("text_hash")
    return state.duplicate_keys(table(spark, sf, "documents").select(text_hash), "text_hash")


# --- pages with missing hashes and objects -------------------------------------------
# Landed: hash missing without </html>. Done before: everything in English, a stale
# hash where the page has a query. Stored as an object: all but German pages.


def _landed(spark, sf):
    return pages(spark, sf).select(
        F.concat(F.lit("PG-"), F.col("page_id").cast("string")).alias("identifier"),
        F.expr("CASE WHEN html LIKE '%</html>%' THEN sha2(cast(html AS binary), 256) END").alias("file_hash"),
    )


def _done(spark, sf):
    return pages(spark, sf).where("url LIKE '%/en/%'").select(
        F.concat(F.lit("PG-"), F.col("page_id").cast("string")).alias("identifier"),
        F.expr("""CASE WHEN url LIKE '%?%' THEN 'old'
            WHEN html LIKE '%</html>%' THEN sha2(cast(html AS binary), 256) END""").alias("source_hash"),
    )


_PENDING_SQL = """landed AS (SELECT concat('PG-', page_id) AS identifier,
        CASE WHEN html LIKE '%</html>%' THEN sha256(html) END AS file_hash, url, html FROM pages),
    done AS (SELECT concat('PG-', page_id) AS identifier, CASE WHEN url LIKE '%?%' THEN 'old'
        WHEN html LIKE '%</html>%' THEN sha256(html) END AS source_hash
        FROM pages WHERE url LIKE '%/en/%'),
    pending AS (SELECT * FROM landed WHERE NOT EXISTS (SELECT 1 FROM done
        WHERE done.identifier = landed.identifier
            AND done.source_hash IS NOT DISTINCT FROM landed.file_hash))"""


def pending_transform(spark, sf):
    return state.pending_transform(_landed(spark, sf), _done(spark, sf)).select("identifier", "file_hash")


def skip_marks(spark, sf):
    return mark_skipped(_landed(spark, sf), _done(spark, sf)).groupBy("skipped").agg(
        F.count(F.lit(1)).alias("n_records")
    )


def _page_records(spark, sf):
    """Landing records of pages; some lack a field that storing requires."""
    identifier = F.concat(F.lit("PG-"), F.col("page_id").cast("string"))
    values = {name: identifier for name in LANDING_FIELDS} | {
        "title": F.expr("CASE WHEN url NOT LIKE '%/fr/%' THEN url END"),
        "description": F.expr("CASE WHEN url NOT LIKE '%/es/%' THEN url END"),
        "file_type": F.lit("html"),
        "file_path": F.expr("CASE WHEN url NOT LIKE '%#top' THEN concat('landing-zone/', page_id, '.html') END"),
        "file_hash": F.expr("CASE WHEN html LIKE '%</html>%' THEN sha2(cast(html AS binary), 256) END"),
    }
    return pages(spark, sf).select(*[v.alias(n) for n, v in values.items()], "html")


def lineage(spark, sf):
    stored = transformed_records(
        _page_records(spark, sf).withColumn("new_hash", F.sha2(F.col("html").cast("binary"), 256))
    )
    return stored.select("identifier", "title", "file_path", "file_hash", "source_hash")


LINEAGE = """SELECT concat('PG-', page_id) AS identifier,
        CASE WHEN url LIKE '%/fr/%' THEN '' ELSE url END AS title,
        concat('transformed-zone/PG-', page_id, '.html') AS file_path, sha256(html) AS file_hash,
        CASE WHEN html LIKE '%</html>%' THEN sha256(html) ELSE '' END AS source_hash FROM pages"""


def landing_projection(spark, sf):
    return _page_records(spark, sf).select(*LANDING_FIELDS)


LANDING_PROJECTION = """SELECT concat('PG-', page_id) AS identifier,
        CASE WHEN url NOT LIKE '%/fr/%' THEN url END AS title,
        CASE WHEN url NOT LIKE '%/es/%' THEN url END AS description,
        concat('PG-', page_id) AS published_date, concat('PG-', page_id) AS ref_no,
        concat('PG-', page_id) AS doc_url, concat('PG-', page_id) AS body,
        concat('PG-', page_id) AS partition_date, 'html' AS file_type,
        CASE WHEN url NOT LIKE '%#top' THEN concat('landing-zone/', page_id, '.html') END AS file_path,
        CASE WHEN html LIKE '%</html>%' THEN sha256(html) END AS file_hash FROM pages"""


def transformed_projection(spark, sf):
    """All twelve fields of the records that can be stored."""
    records = _page_records(spark, sf).withColumn("new_hash", F.lit("new"))
    good, _ = failures.split_rejected(records, record_error())
    return transformed_records(good).select(*TRANSFORMED_FIELDS)


TRANSFORMED_PROJECTION = """SELECT concat('PG-', page_id) AS identifier,
        CASE WHEN url LIKE '%/fr/%' THEN '' ELSE url END AS title, url AS description,
        concat('PG-', page_id) AS published_date, concat('PG-', page_id) AS ref_no,
        concat('PG-', page_id) AS doc_url, concat('PG-', page_id) AS body,
        concat('PG-', page_id) AS partition_date, 'html' AS file_type,
        concat('transformed-zone/PG-', page_id, '.html') AS file_path, 'new' AS file_hash,
        CASE WHEN html LIKE '%</html>%' THEN sha256(html) ELSE '' END AS source_hash
    FROM pages WHERE url NOT LIKE '%/es/%' AND url NOT LIKE '%#top'"""


def record_isolation(spark, sf):
    _, bad = failures.split_rejected(_page_records(spark, sf), record_error())
    return bad.select("identifier", "error")


RECORD_ISOLATION = """SELECT concat('PG-', page_id) AS identifier,
        concat('missing: ', concat_ws(', ', CASE WHEN url LIKE '%/es/%' THEN 'description' END,
            CASE WHEN url LIKE '%#top' THEN 'file_path' END)) AS error
    FROM pages WHERE url LIKE '%/es/%' OR url LIKE '%#top'"""


def _landed_root(spark, sf):
    """Pages landed as objects, but German ones; a second run brings the French ones again."""
    root, fetches = run_root(spark), page_fetches(spark, sf).where("doc_url NOT LIKE '%/de/%'")
    answered = fetches.withColumns({"status": F.lit(200), "content_type": F.lit("text/html")})
    landing.land(spark, answered, root)
    later = F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")
    landing.land(spark, answered.where("doc_url LIKE '%/fr/%'").withColumn("fetched_at", later), root)
    return root


def _records(spark, sf):
    name = F.concat(F.lit("landing-zone/PG-"), F.col("page_id").cast("string"), F.lit(".html"))
    return pages(spark, sf).select("page_id", naming.object_key(name).alias("file_name"))


def _content(spark, sf):
    """Content of all records, read by name and batch as the jobs do."""
    root, records = _landed_root(spark, sf), _records(spark, sf)
    index = landing.current_objects(state.stored_rows_of(landing.landed_index(spark, root), records, "file_name"))
    return landing.content_of(spark, root, index)


def object_scan(spark, sf):
    return _content(spark, sf).select("file_name", naming.content_hash(F.col("content")).alias("sha"))


_PAGE_HTML = "CASE WHEN url LIKE '%/en/%' THEN " + with_container("html") + " ELSE html END"
OBJECT_SCAN = f"""SELECT concat('PG-', page_id, '.html') AS file_name, sha256({_PAGE_HTML}) AS sha
    FROM pages WHERE url NOT LIKE '%/de/%'"""


def content_join(spark, sf):
    """Objects of each language by the records that name them, and their bytes."""
    records = pages(spark, sf).select(
        F.expr("concat('PG-', page_id, '.html')").alias("file_name"), F.expr(PAGE_BODY).alias("body")
    )
    sizes = _content(spark, sf).select("file_name", F.length("content").alias("n"))
    return records.join(sizes, "file_name", "left").groupBy("body", F.col("n").isNotNull().alias("found")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("n").cast("bigint").alias("n_bytes")
    )


CONTENT_JOIN = f"""SELECT {PAGE_BODY} AS body, url NOT LIKE '%/de/%' AS found, count(*) AS n_records,
        CAST(sum(CASE WHEN url NOT LIKE '%/de/%' THEN octet_length(encode({_PAGE_HTML})) END) AS BIGINT) AS n_bytes
    FROM pages GROUP BY ALL"""


def missing_object(spark, sf):
    index = landing.landed_index(spark, _landed_root(spark, sf))
    missing = state.missing_objects(_records(spark, sf), index, "file_name")
    return missing.select("page_id", "file_name", F.lit(NOT_FOUND).alias("error"))


MISSING_OBJECT = """SELECT page_id, concat('PG-', page_id, '.html') AS file_name,
        'content not found' AS error FROM pages WHERE url LIKE '%/de/%'"""


def empty_body_drop(spark, sf):
    """Documents whose body is missing (German) or empty (Spanish) are rejected."""
    body = F.expr("CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN '' ELSE text END").cast("binary")
    docs = table(spark, sf, "documents").select("lang", body.alias("content"))
    error = F.when(failures.is_empty(F.col("content")), "no file content")
    kept, dropped = failures.split_rejected(docs, error)
    counted = kept.withColumn("error", F.lit(None).cast("string")).unionByName(dropped)
    return counted.groupBy("lang", "error").agg(F.count(F.lit(1)).alias("n_documents"))


EMPTY_BODY_DROP = """SELECT lang, CASE WHEN lang IN ('de', 'es') THEN 'no file content' END AS error,
        count(*) AS n_documents FROM documents GROUP BY ALL"""

QUERIES = {
    "upsert_by_key": (_merged, f"WITH {_STATE_SQL} SELECT * FROM merged"),
    "upsert_summary": (upsert_summary, f"""WITH {_STATE_SQL}
        SELECT outcome, count(*) AS n_records FROM merged GROUP BY outcome"""),
    "last_arrival": (last_arrival, """SELECT identifier, n_chars, doc_id FROM (
        SELECT concat(source, '-', lang) AS identifier, n_chars, doc_id, row_number() OVER (
            PARTITION BY source, lang ORDER BY n_chars DESC, doc_id DESC) AS rn FROM documents)
        WHERE rn = 1"""),
    "changed_objects": (changed_objects, f"""WITH {_STATE_SQL}
        SELECT concat(identifier, '.html') AS file_name, file_hash FROM incoming i
        WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.identifier = i.identifier
            AND s.file_hash = i.file_hash)"""),
    "unique_key_check": (unique_key_check, """SELECT sha256(text) AS text_hash, count(*) AS n_rows
        FROM documents GROUP BY ALL HAVING count(*) > 1"""),
    "pending_transform": (pending_transform, f"""WITH {_PENDING_SQL}
        SELECT identifier, file_hash FROM pending"""),
    "skip_marks": (skip_marks, f"""WITH {_PENDING_SQL} SELECT identifier NOT IN
        (SELECT identifier FROM pending) AS skipped, count(*) AS n_records FROM landed GROUP BY ALL"""),
    "lineage": (lineage, LINEAGE),
    "landing_projection": (landing_projection, LANDING_PROJECTION),
    "transformed_projection": (transformed_projection, TRANSFORMED_PROJECTION),
    "record_isolation": (record_isolation, RECORD_ISOLATION),
    "object_scan": (object_scan, OBJECT_SCAN),
    "content_join": (content_join, CONTENT_JOIN),
    "missing_object": (missing_object, MISSING_OBJECT),
    "empty_body_drop": (empty_body_drop, EMPTY_BODY_DROP),
}
