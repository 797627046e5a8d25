"""HTML cleaning and hashing over whole pages.

Results are compared as text through its SHA-256, so every character counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquay.functions import markup, naming
from docquay.plans.transforming import transform_content
from docquay.queries.inputs import (
    CLEAN_SQL,
    PAGE_FETCHES_SQL,
    STABLE_SQL,
    container_sql,
    page_fetches,
    pages,
    strip_re,
    table,
    visible_sql,
    with_container,
    without_chrome,
    without_noise,
)

NAV_WORD = "The"
# The test pages carry none of the marks the chrome rules look for; these put them
# on elements the pages do have. Both dialects read them alike.
BY_ID = """replace(replace(html, '<div class="ad">', '<div id="asideNav">'),
    '<article>', '<article id=asideNav>')"""
CLASS_LIKE = """replace(replace(html, '<div class="ad">', '<div class="x my-navbar-1 y">'),
    '<h1>', '<h1 class="topnavbar">')"""
CLASS_EXACT = """replace(replace(html, '<div class="ad">', '<div class="a lastLetter">'),
    '<h1>', '<h1 class="lastLetterX">')"""


def _hashed(page: Column) -> list[Column]:
    return [
        F.sha2(page.cast("binary"), 256).alias("sha"),
        F.length(page).cast("bigint").alias("n_chars"),
    ]


def _hashed_sql(page: str, source: str = "pages") -> str:
    return f"""SELECT page_id, sha256(page) AS sha, length(page) AS n_chars
        FROM (SELECT page_id, {page} AS page FROM {source})"""


def _per_page(step, html: str = "html"):
    def query(spark, sf):
        return pages(spark, sf).select("page_id", *_hashed(step(F.expr(html))))

    return query


def _container_page(html: str = "html") -> str:
    return f"(SELECT page_id, {with_container(html)} AS html FROM pages)"


def clean_html(spark, sf):
    cleaned = markup.clean_html(pages(spark, sf), link_text=NAV_WORD)
    return cleaned.select("page_id", *_hashed(F.col("cleaned_html")))


def clean_html_container(spark, sf):
    derived = pages(spark, sf).select("page_id", F.expr(with_container("html")).alias("html"))
    return markup.clean_html(derived).select("page_id", *_hashed(F.col("cleaned_html")))


_LINK_RE = rf"<a\b[^>]*>[^<]*{NAV_WORD}[^<]*</a\s*>"
_DIV_RE = {
    "id": r'<div id="asideNav">.*?</div>',
    "like": r'<div class="x my-navbar-1 y">.*?</div>|<h1 class="topnavbar">.*?</h1>',
    "exact": r'<div class="a lastLetter">.*?</div>',
}


def transform_by_type(spark, sf):
    records = page_fetches(spark, sf).select(
        F.col("fetch_id").cast("bigint").alias("page_id"),
        naming.file_type(F.col("content_type")).alias("file_type"), "content",
    )
    return transform_content(records).select(
        "page_id", "file_type", naming.content_hash(F.col("content")).alias("sha")
    )


TRANSFORM_BY_TYPE = f"""WITH {PAGE_FETCHES_SQL} SELECT page_id, file_type,
        sha256(CASE WHEN file_type = 'html' THEN {CLEAN_SQL} ELSE html END) AS sha FROM fetches"""


def content_hash(spark, sf):
    text = F.col("text").cast("binary")
    return table(spark, sf, "documents").select("doc_id", naming.content_hash(text).alias("file_hash"))


def hash_prefix(spark, sf):
    prefix = naming.hash_prefix(naming.content_hash(F.col("text").cast("binary")))
    return table(spark, sf, "documents").select("doc_id", prefix.alias("hash_prefix"))


def stable_html_hash(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select(
        "page_id", "url", naming.stable_html_hash(html).alias("stable_hash"),
        F.length(markup.stable_text(html)).cast("bigint").alias("text_length"),
    )


STABLE_HTML_HASH = f"""SELECT page_id, url, sha256(page) AS stable_hash, length(page) AS text_length
    FROM (SELECT page_id, url, {visible_sql('html')} AS page FROM pages)"""


def stable_html_hash_container(spark, sf):
    html = F.expr(with_container("html"))
    return pages(spark, sf).select("page_id", naming.stable_html_hash(html).alias("stable_hash"))


def hash_ignores_noise(spark, sf):
    """Groups of equal stable hashes among pages and copies with other noise."""
    noisy = F.expr("""replace(replace(html, '<style>', '<script>s="<p>x</p>"</script><style>'),
        '<article>', '<!-- t --><article data-t="<b>">')""")
    page = pages(spark, sf)
    both = page.select("page_id", "html").unionByName(page.select("page_id", noisy.alias("html")))
    return both.select(naming.stable_html_hash(F.col("html")).alias("stable_hash")).groupBy(
        "stable_hash"
    ).agg(F.count(F.lit(1)).alias("n_pages"))


HASH_IGNORES_NOISE = f"""SELECT sha256({visible_sql('html')}) AS stable_hash,
        2 * count(*) AS n_pages FROM pages GROUP BY ALL"""

QUERIES = {
    "container_extract": (
        _per_page(lambda h: markup.content_container(markup.strip_raw_blocks(h)), with_container("html")),
        _hashed_sql(container_sql("html"), _container_page()),
    ),
    "strip_raw_blocks": (
        _per_page(markup.strip_raw_blocks), _hashed_sql(without_noise("html"))
    ),
    "strip_chrome_tags": (
        _per_page(lambda h: markup.strip_chrome_tags(markup.strip_raw_blocks(h))),
        _hashed_sql(without_chrome("html")),
    ),
    "strip_by_id": (
        _per_page(lambda h: markup.strip_by_id(h, "asideNav"), BY_ID),
        _hashed_sql(
            "regexp_replace(html, '(?is){}', '')".format(_DIV_RE["id"]),
            f"(SELECT page_id, {BY_ID} AS html FROM pages)",
        ),
    ),
    "strip_class_like": (
        _per_page(lambda h: markup.strip_class_like(h, "navbar"), CLASS_LIKE),
        _hashed_sql(
            strip_re("html", _DIV_RE["like"]),
            f"(SELECT page_id, {CLASS_LIKE} AS html FROM pages)",
        ),
    ),
    "strip_class_exact": (
        _per_page(lambda h: markup.strip_class_exact(h, *markup.CHROME_CLASSES), CLASS_EXACT),
        _hashed_sql(
            strip_re("html", _DIV_RE["exact"]),
            f"(SELECT page_id, {CLASS_EXACT} AS html FROM pages)",
        ),
    ),
    "strip_links_by_text": (
        _per_page(lambda h: markup.strip_links_by_text(h, NAV_WORD)),
        _hashed_sql(f"regexp_replace(html, '(?s){_LINK_RE}', '', 'g')"),
    ),
    "visible_text": (_per_page(markup.visible_text), _hashed_sql(visible_sql("html"))),
    "clean_html": (clean_html, _hashed_sql(
        f"regexp_replace({without_chrome('html')}, '(?s){_LINK_RE}', '', 'g')")),
    "clean_html_container": (clean_html_container, _hashed_sql(CLEAN_SQL, _container_page())),
    "transform_by_type": (transform_by_type, TRANSFORM_BY_TYPE),
    "content_hash": (
        content_hash, "SELECT doc_id, sha256(text) AS file_hash FROM documents"
    ),
    "hash_prefix": (
        hash_prefix, "SELECT doc_id, left(sha256(text), 12) AS hash_prefix FROM documents"
    ),
    "stable_html_hash": (stable_html_hash, STABLE_HTML_HASH),
    "stable_html_hash_container": (
        stable_html_hash_container,
        f"SELECT page_id, sha256({STABLE_SQL}) AS stable_hash FROM {_container_page()}",
    ),
    "hash_ignores_noise": (hash_ignores_noise, HASH_IGNORES_NOISE),
}
