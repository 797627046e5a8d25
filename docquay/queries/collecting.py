"""Scans, crawl plan and record extraction."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from docquay.functions import dates, naming, urls
from docquay.operators import extraction, state
from docquay.operators.extraction import CardLayout, Field
from docquay.plans import crawl
from docquay.plans.landing import card_requests
from docquay.plans.schemas import EVENTS
from docquay.queries.inputs import (
    ORDER_MONTH_SPARK,
    ORDER_MONTH_SQL,
    ORDERS_SQL,
    SEARCH_BASE,
    orders,
    pages,
    table,
)
from docquay.sources.event_log import event_counts, event_line, log_path, read_events, unreadable_lines, write_events
from docquay.sources.registry import parse_sources
from docquay.sources.staging import staging_root

NAV = CardLayout(
    item=Field("li"), identifier=Field("a"), title=Field("b"), link=Field("a", None, "href")
)
COUNT_HTML = """concat('<body><div class="searchhead">Shows 1 to 10 of ',
    {number}, ' results</div><p>of 7 results</p></body>')"""


# --- scans -------------------------------------------------------------------------


def month_range_scan(spark, sf):
    labelled = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(ORDER_MONTH_SPARK).alias("partition_date"), "o_orderdate"
    )
    scan = state.month_range_scan(labelled, "1996-03-15", "1997-02-01", day="o_orderdate")
    return scan.drop("o_orderdate")


MONTH_RANGE_SCAN = f"""SELECT o_orderkey, {ORDER_MONTH_SQL} AS partition_date FROM orders
    WHERE {ORDER_MONTH_SQL} BETWEEN '1996-03' AND '1997-02'"""


def source_registry(spark, sf):
    text = F.concat(
        F.lit(" "), "n_name", F.lit(" : "), F.col("n_nationkey").cast("string"),
        F.lit(":x, Region:"), F.col("n_regionkey").cast("string"),
    )
    return table(spark, sf, "nation").select("n_nationkey", F.inline(parse_sources(text)))


SOURCE_REGISTRY = """SELECT n_nationkey, trim(split_part(pair, ':', 1)) AS body,
        trim(split_part(pair, ':', 2)) AS body_id
    FROM (SELECT n_nationkey, unnest(string_split(concat(' ', n_name, ' : ', n_nationkey,
        ':x, Region:', n_regionkey), ',')) AS pair FROM nation)"""


def _event_lines(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    line = event_line(
        F.col("ts"), F.lit("INFO"), F.lit("docs"), F.format_string("Event %d", "event_id"),
        {
            "event": F.col("event_type"), "error_code": k,
            "level": F.when(F.col("event_type") == "error", "WARNING").otherwise("INFO"),
            "identifier": F.col("user_id").cast("string"),
        },
    )
    return table(spark, sf, "events").select(line.alias("value"))


def event_log_write(spark, sf):
    path = log_path(staging_root(spark), "docs", datetime.now())
    write_events(_event_lines(spark, sf), path)
    return read_events(spark, path, EVENTS).select(
        "timestamp", "level", "logger", "message", "event", "error_code", "identifier"
    )


EVENT_LOG_WRITE = """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
        CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END ||
        '+00:00' AS "timestamp",
        CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END AS level,
        'docs' AS logger, concat('Event ', event_id) AS message, event_type AS event,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS error_code,
        CAST(user_id AS VARCHAR) AS identifier
    FROM events"""


_LINE = """concat('{"event": "', event_type, '", "error_code": ', cast(event_id % 100 AS varchar(9)),
    ', "identifier": "', cast(event_id AS varchar(20)), '"}')"""
# Errors are cut off, as by a writer that was lost; signups have text where a number belongs.
_LINE_AS_WRITTEN = f"""CASE event_type WHEN 'error' THEN substring({_LINE}, 1, length({_LINE}) - 3)
    WHEN 'signup' THEN replace({_LINE}, '"error_code": ', '"error_code": "n/a", "was": ') ELSE {_LINE} END"""


def event_log_broken(spark, sf):
    """Events of a log with broken lines, and these lines as they are."""
    path = log_path(staging_root(spark), "docs", datetime.now())
    write_events(table(spark, sf, "events").select(F.expr(_LINE_AS_WRITTEN).alias("value")), path)
    none = F.lit(None).cast("string")
    return read_events(spark, path, EVENTS).select("event", "error_code", "identifier", none.alias("line")).union(
        unreadable_lines(spark, path, EVENTS).select(none, F.lit(None).cast("int"), none, "value")
    )


EVENT_LOG_BROKEN = f"""SELECT event_type AS event, CAST(event_id % 100 AS INTEGER) AS error_code,
        CAST(event_id AS VARCHAR) AS identifier, NULL AS line FROM events
        WHERE event_type NOT IN ('error', 'signup')
    UNION ALL SELECT NULL, NULL, NULL, {_LINE_AS_WRITTEN} FROM events WHERE event_type IN ('error', 'signup')"""


def event_log_scan(spark, sf):
    """Events of a written log, by kind."""
    path = log_path(staging_root(spark), "docs", datetime.now())
    write_events(_event_lines(spark, sf), path)
    events = read_events(spark, path, EVENTS)
    sums = events.groupBy("event").agg(
        F.sum("error_code").alias("sum_k"), F.count_if(F.col("error_code") >= 50).alias("n_high")
    )
    return event_counts(events).join(sums, "event")


EVENT_LOG_SCAN = """SELECT event_type AS event, count(*) AS n_events,
        CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
        count(*) FILTER (CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50) AS n_high
    FROM events GROUP BY event_type"""


# --- crawl plan -----------------------------------------------------------------------


def _bounds(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))


_MONTHS_SQL = """bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo,
        max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
    months AS (SELECT CAST(m AS DATE) AS first, hi FROM bounds,
        generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(hi AS TIMESTAMP),
            INTERVAL 1 MONTH) AS g(m) WHERE CAST(m AS DATE) < hi),
    windows AS (SELECT strftime(first, '%-d/%-m/%Y') AS from_date,
        strftime(least(last_day(first), hi), '%-d/%-m/%Y') AS to_date,
        strftime(first, '%Y-%m') AS "partition" FROM months)"""


def month_partitions(spark, sf):
    return _bounds(spark, sf).select(F.inline(dates.month_windows(F.col("lo"), F.col("hi"))))


MONTH_PARTITIONS = f'WITH {_MONTHS_SQL} SELECT from_date, to_date, "partition" FROM windows'


def _sources(spark, sf):
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("body"),
        F.concat("n_name", F.lit(" *~:"), F.col("n_nationkey").cast("string")).alias("body_id"),
    )


def crawl_plan(spark, sf):
    bounds = _bounds(spark, sf)
    plan = crawl.crawl_plan(
        _sources(spark, sf), bounds.select("lo").scalar(), bounds.select("hi").scalar(), SEARCH_BASE
    )
    return plan.orderBy("partition", "body")


_URL_SQL = f"""concat('{SEARCH_BASE}?decisions=1&from=', replace(from_date, '/', '%2F'),
    '&to=', replace(to_date, '/', '%2F'), '&body=',
    replace(replace(url_encode(body_id), '%20', '+'), '%7E', '~'),
    CASE WHEN page > 1 THEN concat('&pageNumber=', page) ELSE '' END)"""
CRAWL_PLAN = f"""WITH {_MONTHS_SQL}, plan AS (SELECT "partition", from_date, to_date,
        n_name AS body, concat(n_name, ' *~:', n_nationkey) AS body_id, CAST(1 AS BIGINT) AS page
        FROM windows, nation)
    SELECT *, {_URL_SQL} AS url FROM plan"""


def _priority_plan(spark, sf):
    """Months x priorities with the number of orders as number of results."""
    priorities = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("body")).distinct()
    bounds = _bounds(spark, sf)
    plan = crawl.crawl_plan(
        priorities.withColumn("body_id", F.substring("body", 1, 1)),
        bounds.select("lo").scalar(), bounds.select("hi").scalar(), SEARCH_BASE,
    )
    totals = orders(spark, sf).groupBy("partition", "body").agg(F.count(F.lit(1)).alias("total"))
    first = plan.drop("url").join(totals, ["partition", "body"], "left").withColumns({
        "n_cards": F.least(F.coalesce("total", F.lit(0)), F.lit(10)),
        "n_pages": extraction.page_count(F.col("total")),
    })
    return plan, first


_TOTALS_SQL = f"""{_MONTHS_SQL}, priorities AS (SELECT DISTINCT o_orderpriority AS body FROM orders),
    totals AS (SELECT "partition", body, count(*) AS total FROM {ORDERS_SQL} GROUP BY ALL),
    first AS (SELECT w.*, body, left(body, 1) AS body_id,
        CAST(ceil(total / 10.0) AS BIGINT) AS n_pages
        FROM windows w CROSS JOIN priorities LEFT JOIN totals USING ("partition", body)),
    more AS (SELECT "partition", from_date, to_date, body, body_id, page
        FROM first, unnest(range(2, n_pages + 1)) AS p(page))"""
_PLAN_COLUMNS = '"partition", from_date, to_date, body, body_id, page'


def page_expansion(spark, sf):
    return crawl.page_expansion(_priority_plan(spark, sf)[1], SEARCH_BASE)


PAGE_EXPANSION = f"WITH {_TOTALS_SQL} SELECT {_PLAN_COLUMNS}, {_URL_SQL} AS url FROM more"


def plan(spark, sf):
    return crawl.full_plan(*_priority_plan(spark, sf), SEARCH_BASE)


PLAN = f"""WITH {_TOTALS_SQL}, requests AS (SELECT {_PLAN_COLUMNS} FROM more UNION ALL
        SELECT "partition", from_date, to_date, body, body_id, CAST(1 AS BIGINT) AS page FROM first)
    SELECT {_PLAN_COLUMNS}, {_URL_SQL} AS url FROM requests"""


def duplicates_allowed(spark, sf):
    """The plan sent twice keeps both copies of every request."""
    first, pages_ = _priority_plan(spark, sf)
    again = crawl.full_plan(first, pages_, SEARCH_BASE).unionByName(first)
    return again.groupBy("partition", "body").agg(F.count(F.lit(1)).alias("n_requests"))


DUPLICATES_ALLOWED = f"""WITH {_TOTALS_SQL}, requests AS (
        SELECT "partition", body FROM more UNION ALL SELECT "partition", body FROM first
        UNION ALL SELECT "partition", body FROM first)
    SELECT "partition", body, count(*) AS n_requests FROM requests GROUP BY ALL"""


# --- extraction -----------------------------------------------------------------------


def card_explode(spark, sf):
    cards = extraction.explode_cards(pages(spark, sf).select("page_id", "html"), layout=NAV)
    return cards.select("page_id", F.col("position").cast("bigint").alias("position"), "card")


_CARDS_SQL = """(SELECT page_id, unnest(range(len(items))) AS position, unnest(items) AS card,
        url FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<li>.*?</li>') AS items
            FROM pages))"""
CARD_EXPLODE = f"SELECT page_id, position, card FROM {_CARDS_SQL}"


def card_nested(spark, sf):
    """Every page as the content of one more list item: that item and those inside it are cards."""
    inside = F.concat(F.lit("<ul><li>"), "html", F.lit("</li></ul>"))
    results = pages(spark, sf).select("page_id", inside.alias("html"))
    cards = extraction.explode_cards(results, layout=NAV)
    return cards.select(
        "page_id", F.col("position").cast("bigint").alias("position"),
        F.regexp_count("card", F.lit("<li>")).cast("bigint").alias("n_items"),
        F.when(F.col("position") > 0, F.col("card")).alias("card"),
    )


CARD_NESTED = f"""SELECT page_id, position + 1 AS position, CAST(1 AS BIGINT) AS n_items, card FROM {_CARDS_SQL}
    UNION ALL SELECT page_id, 0, 1 + len(regexp_extract_all(html, '<li>')), NULL FROM pages"""


def _nav_cards(spark, sf):
    results = pages(spark, sf).select("page_id", F.col("url").alias("page_url"), "html")
    return extraction.card_fields(extraction.explode_cards(results, layout=NAV), NAV)


def card_fields(spark, sf):
    return _nav_cards(spark, sf).select(
        "page_id", F.col("position").cast("bigint").alias("position"),
        "identifier", "link", "description", "ref_no",
    )


_LINK_SQL = "regexp_extract(card, 'href=\"([^\"]*)\"', 1)"
_TEXT_SQL = "trim(regexp_extract(card, '<a[^>]*>([^<]*)', 1))"
CARD_FIELDS = f"""SELECT page_id, position, {_TEXT_SQL} AS identifier, {_LINK_SQL} AS link,
        '' AS description, '' AS ref_no FROM {_CARDS_SQL}"""


def title_fallback(spark, sf):
    return _nav_cards(spark, sf).select(
        "page_id", F.col("position").cast("bigint").alias("position"), "title"
    )


TITLE_FALLBACK = f"SELECT page_id, position, {_TEXT_SQL} AS title FROM {_CARDS_SQL}"


def url_resolve(spark, sf):
    return extraction.with_document_url(_nav_cards(spark, sf)).select(
        "page_id", F.col("position").cast("bigint").alias("position"), "doc_url"
    )


URL_RESOLVE = f"""SELECT page_id, position,
        concat(regexp_extract(url, '^[a-z]+://[^/?#]*'), {_LINK_SQL}) AS doc_url FROM {_CARDS_SQL}"""


def _document_results(spark, sf):
    """Result pages in the default layout: ten documents to a page, per language."""
    doc_id = F.col("doc_id").cast("string")
    name = F.when(F.col("n_chars") > 300, F.concat(F.lit("DOC-"), doc_id)).otherwise("")
    link = F.when(F.col("n_chars") > 600, F.concat(F.lit("../d/"), doc_id, F.lit(".html?a=1&amp;b=2"))).otherwise("")
    heading = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("Case &quot;"), doc_id, F.lit("&quot;"))).otherwise("")
    card = F.concat(
        F.lit('<li class="each-item odd"><h2 class="title" title="'), name, F.lit('">'), heading,
        F.lit('</h2><span class="date"> 17/07/2025 </span><p title="'), F.col("source"),
        F.lit(' v State" class="description">..</p><span class=refNO>R'), doc_id,
        F.lit('</span><ul><li>note</li></ul><a href="'), link,
        F.lit('" class="btn btn-primary">View</a></li>'),
    )
    page = F.floor(F.col("doc_id") / 10).cast("bigint")
    grouped = table(spark, sf, "documents").groupBy(page.alias("page"), "lang").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", card.alias("c")))),
                                 lambda r: r["c"]), "").alias("cards")
    )
    return grouped.select(
        F.lit("2024-01").alias("partition"), F.col("lang").alias("body"), "page",
        F.concat(F.lit("http://h.example.org/en/search/?p="), F.col("page").cast("string")).alias("page_url"),
        F.concat(F.lit('<html><!-- <li class="each-item">x</li> --><ul class="list">'), "cards",
                 F.lit("</ul></html>")).alias("html"),
    )


def card_records(spark, sf):
    """Document requests from result pages in the default layout."""
    return card_requests(_document_results(spark, sf))[0].drop("position")


_DOC_LINK = "concat('http://h.example.org/en/d/', doc_id, '.html?a=1&b=2')"
CARD_RECORDS = f"""SELECT concat('DOC-', doc_id) AS identifier,
        CASE WHEN n_chars % 2 = 0 THEN concat('Case "', doc_id, '"')
            ELSE concat('DOC-', doc_id) END AS title,
        concat(source, ' v State') AS description, '17/07/2025' AS published_date,
        concat('R', doc_id) AS ref_no, {_DOC_LINK} AS doc_url, lang AS body,
        '2024-01' AS partition_date, doc_id // 10 AS page
    FROM documents WHERE n_chars > 600"""


def required_fields(spark, sf):
    dropped = card_requests(_document_results(spark, sf))[1]
    return dropped.groupBy("body", "error").agg(F.count(F.lit(1)).alias("n_cards"))


REQUIRED_FIELDS_SQL = """SELECT lang AS body, CASE WHEN n_chars <= 300 THEN 'identifier missing'
        ELSE 'link missing' END AS error, count(*) AS n_cards
    FROM documents WHERE n_chars <= 600 GROUP BY ALL"""


def _count_pages(spark, sf):
    totals = orders(spark, sf).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    html = F.expr(COUNT_HTML.format(number="format_number(n * 37, 0)"))
    return totals.select("partition", extraction.result_count(html).alias("total"))


def result_count(spark, sf):
    return _count_pages(spark, sf)


RESULT_COUNT = f"""SELECT "partition", count(*) * 37 AS total FROM {ORDERS_SQL} GROUP BY ALL"""


def page_count(spark, sf):
    return _count_pages(spark, sf).select("partition", extraction.page_count(F.col("total")).alias("n_pages"))


PAGE_COUNT = f"""SELECT "partition", (count(*) * 37 + 9) // 10 AS n_pages
    FROM {ORDERS_SQL} GROUP BY ALL"""

_SOURCE_TYPE = """CASE WHEN source = 'src0' THEN 'Application/PDF' WHEN source = 'src1'
    THEN 'application/msword' WHEN source = 'src2'
    THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
    WHEN source = 'src3' THEN 'text/html; charset=utf-8' WHEN source = 'src4' THEN 'image/png'
    ELSE NULL END"""
_SOURCE_EXT = """CASE WHEN source = 'src0' THEN 'pdf' WHEN source IN ('src1', 'src2') THEN 'doc'
    ELSE 'html' END"""
_EXT_SQL = "CASE WHEN source IN ('src5', 'src6') THEN 'zip' ELSE " + _SOURCE_EXT + " END"


def file_type(spark, sf):
    kind = naming.file_type(F.expr(_SOURCE_TYPE))
    return table(spark, sf, "documents").select("doc_id", kind.alias("file_type"))


FILE_TYPE = f"SELECT doc_id, {_SOURCE_EXT} AS file_type FROM documents"


def mime_type(spark, sf):
    mime = naming.mime_type(F.expr(_EXT_SQL))
    return table(spark, sf, "documents").select("doc_id", mime.alias("content_type"))


MIME_TYPE = f"""SELECT doc_id, CASE {_EXT_SQL} WHEN 'html' THEN 'text/html'
        WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword'
        ELSE 'application/octet-stream' END AS content_type FROM documents"""


def object_name(spark, sf):
    name = naming.object_name(F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")), F.expr(_SOURCE_EXT))
    return table(spark, sf, "documents").select(
        "doc_id", name.alias("file_name"), naming.object_path(naming.LANDING_ZONE, name).alias("file_path")
    )


OBJECT_NAME = f"""SELECT doc_id, concat('DOC-', doc_id, '.', {_SOURCE_EXT}) AS file_name,
        concat('landing-zone/DOC-', doc_id, '.', {_SOURCE_EXT}) AS file_path FROM documents"""


def object_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", naming.object_key(F.col("url")).alias("object_key"))


OBJECT_KEY = """SELECT page_id, CASE WHEN strpos(url, '/') = 0 THEN url
        ELSE substr(url, strpos(url, '/') + 1) END AS object_key FROM pages"""


def month_of(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_of(F.col("o_orderdate")).alias("month"),
        dates.month_of_text(F.col("o_orderdate").cast("string")).alias("month_of_text"),
    )


MONTH_OF = f"SELECT o_orderkey, {ORDER_MONTH_SQL} AS month, {ORDER_MONTH_SQL} AS month_of_text FROM orders"


def published_on(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", "soon").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    day = dates.published_on(text)
    return table(spark, sf, "orders").select("o_orderkey", day.cast("string").alias("published_on"))


PUBLISHED_ON = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS published_on FROM orders"""


def search_url(spark, sf):
    url = urls.search_url(
        SEARCH_BASE, F.date_format("o_orderdate", "d/M/yyyy"), F.date_format("o_orderdate", "d/M/yyyy"),
        F.col("o_orderpriority"), F.col("o_custkey") % 3,
    )
    return table(spark, sf, "orders").select("o_orderkey", url.alias("url"))


SEARCH_URL = """SELECT o_orderkey, """ + _URL_SQL + """ AS url FROM (SELECT o_orderkey,
    strftime(o_orderdate, '%-d/%-m/%Y') AS from_date, strftime(o_orderdate, '%-d/%-m/%Y') AS to_date,
    o_orderpriority AS body_id, o_custkey % 3 AS page FROM orders)"""

QUERIES = {
    "month_range_scan": (month_range_scan, MONTH_RANGE_SCAN),
    "source_registry": (source_registry, SOURCE_REGISTRY),
    "event_log_write": (event_log_write, EVENT_LOG_WRITE),
    "event_log_broken": (event_log_broken, EVENT_LOG_BROKEN),
    "event_log_scan": (event_log_scan, EVENT_LOG_SCAN),
    "month_partitions": (month_partitions, MONTH_PARTITIONS),
    "crawl_plan": (crawl_plan, CRAWL_PLAN),
    "search_url": (search_url, SEARCH_URL),
    "page_expansion": (page_expansion, PAGE_EXPANSION),
    "duplicates_allowed": (duplicates_allowed, DUPLICATES_ALLOWED),
    "plan": (plan, PLAN),
    "card_explode": (card_explode, CARD_EXPLODE),
    "card_nested": (card_nested, CARD_NESTED),
    "card_fields": (card_fields, CARD_FIELDS),
    "card_records": (card_records, CARD_RECORDS),
    "title_fallback": (title_fallback, TITLE_FALLBACK),
    "required_fields": (required_fields, REQUIRED_FIELDS_SQL),
    "url_resolve": (url_resolve, URL_RESOLVE),
    "result_count": (result_count, RESULT_COUNT),
    "page_count": (page_count, PAGE_COUNT),
    "file_type": (file_type, FILE_TYPE),
    "mime_type": (mime_type, MIME_TYPE),
    "object_name": (object_name, OBJECT_NAME),
    "object_key": (object_key, OBJECT_KEY),
    "month_of": (month_of, MONTH_OF),
    "published_on": (published_on, PUBLISHED_ON),
}
