"""Golden cases of plan, extraction, state, accounting and failures."""

from datetime import date, datetime
from urllib.parse import urlencode, urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docquay.functions import dates, naming, urls
from docquay.operators import accounting, extraction, failures, state
from docquay.plans import crawl
from docquay.plans.landing import card_requests
from docquay.sources.registry import source_registry
from docquay.sources.tables import read_objects

BASE = "http://h/en/search/"
few = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def windows(spark, start, end):
    rows = crawl.month_partitions(spark, start, end).orderBy("partition").collect()
    return [tuple(r) for r in rows]


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_month_partitions(spark):
    assert windows(spark, "2024-01-01", "2024-04-01") == [
        ("1/1/2024", "31/1/2024", "2024-01"), ("1/2/2024", "29/2/2024", "2024-02"),
        ("1/3/2024", "31/3/2024", "2024-03"),
    ]
    assert windows(spark, "2024-01-15", "2024-04-10")[::3] == [
        ("1/1/2024", "31/1/2024", "2024-01"), ("1/4/2024", "10/4/2024", "2024-04"),
    ]
    assert windows(spark, "2024-01-01", "2024-01-01") == []
    assert windows(spark, "2024-05-01", "2024-01-01") == []
    assert windows(spark, "2024-05-20", "2024-05-10") == [("1/5/2024", "10/5/2024", "2024-05")]


@few
@given(st.dates(date(1990, 1, 1), date(2030, 1, 1)), st.dates(date(1990, 1, 1), date(2030, 1, 1)))
def test_windows_cover_the_range_without_overlap(spark, start, end):
    rows = windows(spark, start.isoformat(), end.isoformat())

    def parse(text):
        return datetime.strptime(text, "%d/%m/%Y").date()

    for (_, to, _), (following, _, _) in zip(rows, rows[1:]):
        assert (parse(following) - parse(to)).days == 1
    if rows:
        assert parse(rows[0][0]) == start.replace(day=1)
        last = parse(rows[-1][1])
        assert last == end or (end.day == 1 and (end - last).days == 1)


@pytest.mark.parametrize("bounds", [("2024-1", "2024-02-01"), (None, "2024-02-01"), ("2024-01-01", "")])
def test_bounds_are_checked(bounds):
    with pytest.raises(ValueError):
        dates.parse_bounds(*bounds)


def test_registry_and_plan(spark):
    sources = source_registry(spark, "Labour Board : 3 ,Other:15:x, Labour Board:4")
    assert sorted((r.body, r.body_id) for r in sources.collect()) == [("Labour Board", "4"), ("Other", "15")]
    four = source_registry(spark, "a:1,b:2,c:3,d:4")
    bounds = [F.lit(d).cast("date") for d in ("2024-01-01", "2024-04-01")]
    plan = crawl.crawl_plan(four, *bounds, BASE)
    assert plan.count() == 12
    assert plan.where("body = 'c' AND partition = '2024-01'").first().url == (
        BASE + "?decisions=1&from=1%2F1%2F2024&to=31%2F1%2F2024&body=3"
    )
    first = plan.where("body = 'c'").withColumns({
        "n_cards": F.when(F.col("partition") == "2024-02", 0).otherwise(10),
        "n_pages": F.when(F.col("partition") == "2024-03", F.lit(2501)).otherwise(3),
    })
    more = crawl.page_expansion(first.drop("page", "url"), BASE)
    assert {tuple(r) for r in more.groupBy("partition").count().collect()} == {("2024-01", 2), ("2024-03", 2500)}
    assert more.where("partition = '2024-01' AND page = 2").first().url.endswith("&body=3&pageNumber=2")
    assert more.select("page").where("partition = '2024-03'").distinct().count() == 2500


def test_form_encoding(spark):
    text = "a b/c~d*e+é&="
    encoded = one(spark, urls.form_encode(F.lit(text)))
    assert "v=" + encoded == urlencode({"v": text})


LINKS = [
    "/x", "x", "../x", "../../../x", "./x", ".", "..", "x/.", "x/..", "?a=b", "#z", "//k.l/m?n",
    "http://o.p/q", "mailto:a@b", "", "x/./y/../z", "/a/../../b", "a//b", "//k.l", "x?y#z",
    "http:foo", "HTTP://x/y", "/", "//", "a/b/", "javascript:void(0)",
]
BASES = [
    "http://a.b/c/d/e?q=1#f", "https://h.x", "https://h.x/", "http://a.b/c/", "http://a.b//c//d",
    "http://u:p@h:80/x/../y",
]


def test_links_resolve_as_in_the_standard_library(spark):
    pairs = [(b, link) for b in BASES for link in LINKS]
    df = spark.createDataFrame(pairs, "b string, l string")
    rows = df.select("b", "l", urls.resolve_url(F.col("b"), F.col("l")).alias("r")).collect()
    assert [(r.b, r.l, r.r) for r in rows] == [(r.b, r.l, urljoin(r.b, r.l)) for r in rows]


def test_types_and_names(spark):
    cases = {
        "application/pdf": "pdf", "Application/MSWord": "doc", "text/html; charset=x": "html",
        "application/vnd.openxmlformats-officedocument.presentationml": "doc", None: "html", "": "html",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert [r[0] for r in df.select(naming.file_type(F.col("c"))).collect()] == list(cases.values())
    mimes = {"html": "text/html", "pdf": "application/pdf", "doc": "application/msword",
             "zip": "application/octet-stream", None: "application/octet-stream"}
    df = spark.createDataFrame([(m,) for m in mimes], "m string")
    assert [r[0] for r in df.select(naming.mime_type(F.col("m"))).collect()] == list(mimes.values())
    for path, key in {"landing-zone/A.html": "A.html", "a/b/c": "b/c", "x": "x"}.items():
        assert one(spark, naming.object_key(F.lit(path))) == key


def test_result_counts(spark):
    cases = {
        '<div class="searchhead">Shows 1 to 10 of 1,562 results</div><p>of 9 results</p>': (1562, 157),
        "<p>Shows 1 to 5 of 5 results</p>": (5, 1),
        '<div class="searchhead">none</div><p>of\n20   results</p>': (20, 2),
        "<p>no text</p>": (None, None), "of , results": (None, None),
    }
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, h string")
    total = extraction.result_count(F.col("h"))
    rows = df.select("i", total.alias("n"), extraction.page_count(total).alias("p")).orderBy("i").collect()
    assert [(r.n, r.p) for r in rows] == list(cases.values())


def test_cards_without_identifier_or_link_are_dropped(spark):
    card = '<li class="each-item"><h2 class="title" title="{}">{}</h2><a class="btn-primary" href="{}">v</a></li>'
    html = "<ul>" + card.format(" A ", "", "a.html") + card.format("", "t", "b") + card.format("C", "t", "") + "</ul>"
    results = spark.createDataFrame(
        [("2024-01", "B", 1, "http://h/s/p?x=1", html)],
        "partition string, body string, page bigint, page_url string, html string",
    )
    kept, dropped = card_requests(results)
    row = kept.first()
    assert (kept.count(), row.identifier, row.title, row.doc_url) == (1, "A", "A", "http://h/s/a.html")
    assert (row.partition_date, row.description, row.ref_no) == ("2024-01", "", "")
    assert sorted(r.error for r in dropped.collect()) == ["identifier missing", "link missing"]


def test_base_tag(spark):
    cases = {"<base href='/d/'>": "http://h/d/", "<p>": "http://h/s/p", "<!-- <base href='/d/'> -->": "http://h/s/p"}
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    rows = df.select(extraction.base_url(F.col("h"), F.lit("http://h/s/p"))).collect()
    assert [r[0] for r in rows] == list(cases.values())


def test_month_range_prunes_directories(spark, tmp_path):
    rows = [(m, i) for i, m in enumerate(["2023-12", "2024-01", "2024-06", "2025-01", "2025-02"])]
    spark.createDataFrame(rows, "partition_date string, n int").write.partitionBy(
        "partition_date").parquet(str(tmp_path / "t"))
    scan = state.month_range_scan(spark.read.parquet(str(tmp_path / "t")), "2024-01-01", "2025-01-01")
    assert sorted(r.partition_date for r in scan.collect()) == ["2024-01", "2024-06", "2025-01"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_upsert_keeps_other_fields_and_sets_nulls(spark):
    stored = spark.createDataFrame(
        [("a", "x", "n1"), ("b", "x", "n2"), ("c", None, "n3"), ("d", "x", "n4")],
        "k string, v string, note string",
    )
    incoming = spark.createDataFrame([("a", "x"), ("b", None), ("c", None), ("e", "y")], "k string, v string")
    rows = {r.k: (r.v, r.note, r.outcome) for r in state.upsert(stored, incoming, "k", ["v"]).collect()}
    assert rows == {
        "a": ("x", "n1", "unchanged"), "b": (None, "n2", "updated"), "c": (None, "n3", "unchanged"),
        "d": ("x", "n4", "kept"), "e": ("y", None, "inserted"),
    }
    fewer = state.upsert(stored, incoming, "k", ["v"], keep_untouched=False)
    assert sorted(r.k for r in fewer.collect()) == ["a", "b", "c", "e"]


def test_skip_is_null_safe(spark):
    landed = spark.createDataFrame([("a", "1"), ("b", None), ("c", None), ("d", "2")], "identifier string, file_hash string")
    done = spark.createDataFrame([("a", "1"), ("b", None), ("c", "")], "identifier string, source_hash string")
    assert sorted(r.identifier for r in state.pending_transform(landed, done).collect()) == ["c", "d"]


def test_last_arrival_of_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    rows = state.last_arrival(df, "k", "id")
    assert rows.count() == 20001
    assert rows.where("k = 'hot'").first().id == 29997
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max(") >= 1 and "Window" not in plan


def test_failure_lists_are_whole_and_bounded(spark):
    rows = spark.range(9000).select(
        F.lit("2024-01").alias("partition"), F.lit("A").alias("body"),
        F.when(F.col("id") < 3000, "http://h/same").otherwise(F.concat(F.lit("http://h/"), F.col("id").cast("string"))).alias("url"),
        F.lit(500).alias("error_code"), F.lit("HTTP 500").alias("reason"),
    )
    lists = accounting.failed_list(rows, chunk_rows=100).collect()
    assert sum(r.records_failed for r in lists) == 9000
    assert len({f.url for r in lists for f in r.failures}) == 6001
    assert sum(len(r.failures) for r in lists) == 6001
    assert max(len(r.failures) for r in lists) < 200
    assert all([f.url for f in r.failures] == sorted(f.url for f in r.failures) for r in lists)


def test_failures_and_retries(spark):
    df = spark.createDataFrame(
        [("2024-01", "A", 503, None), (None, None, None, "timeout")],
        "partition string, body string, status int, reason string",
    )
    rows = [tuple(r) for r in failures.classify_failures(df).select("partition", "body", "error_code", "reason").collect()]
    assert rows == [("2024-01", "A", 503, "HTTP 503"), ("unknown", "unknown", 0, "timeout")]
    tries = [("a", 503, 1), ("a", 200, 2), ("b", 200, 1), ("b", 429, 2), ("c", 404, 1), ("e", 500, 1)]
    tries += [("d", 500, n) for n in range(6)] + [("f", 500, n) for n in range(5)] + [("g", None, 1)]
    work = failures.retry_worklist(spark.createDataFrame(tries, "url string, status int, fetched_at int"))
    assert [(r.url, r.retries) for r in work.collect()] == [("e", 0), ("b", 1), ("f", 4)]


def test_files_as_objects(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A-1.pdf").write_bytes(b"%PDF")
    (tmp_path / "A-2.html").write_bytes(b"<p>")
    rows = {r.file_name: bytes(r.content) for r in read_objects(spark, str(tmp_path)).collect()}
    assert rows == {"A-1.pdf": b"%PDF", "A-2.html": b"<p>"}
