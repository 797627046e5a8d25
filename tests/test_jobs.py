"""Landing, transforming, reporting and streaming end to end on small fixtures."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docquay.operators import accounting
from docquay.operators.state import stored_rows_of
from docquay.plans import landing, reporting, transforming
from docquay.plans.schemas import EVENTS, FETCHES
from docquay.sources.event_log import event_counts, log_path, read_events, unreadable_lines, write_events
from docquay.sources.tables import DELETED, STATE_BUCKETS, RunLog, append_batch
from docquay.streaming.landing import arriving_fetches, land_stream

PAGE = '<html><body><nav>n</nav><div class="content"><p>{}</p></div></body></html>'


def fetch(identifier, content, month="2024-01", status=200, kind="text/html", at=1, **other):
    row = dict(
        identifier=identifier, title="T", description="d", published_date="17/07/2025",
        ref_no="r", doc_url=f"http://h/{identifier}", body="A", partition_date=month,
        page=1, position=0, status=status, reason=None, content_type=kind,
        content=content if content is None else content.encode(),
        fetched_at=datetime(2024, 1, 1, 0, at), fetch_id=f"{identifier}/{month}/{at}/{kind}",
    )
    row.update(other)
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in FETCHES.names) for r in rows], FETCHES)


def metadata(spark, root):
    return {r.identifier: r for r in landing.landed_records(spark, root).collect()}


def objects(spark, root):
    """Current bytes of every object."""
    index = landing.current_objects(landing.landed_index(spark, root))
    rows = landing.content_of(spark, root, index).collect()
    assert len({r.file_name for r in rows}) == len(rows)
    return {r.file_name: bytes(r.content) for r in rows}


def outcomes(landed):
    return {r.identifier: r.outcome for r in landed.outcomes.collect()}


@pytest.fixture
def first(spark):
    return frame(spark, [
        fetch("A-1", PAGE.format("one")),
        fetch("A-2", PAGE.format("two")),
        fetch("A-2", PAGE.format("two, later"), at=5),
        fetch("A-3", "%PDF", kind="application/pdf", month="2024-02"),
        fetch("A-4", "", month="2024-02"),
        fetch("A-5", None, status=503),
        fetch("A-6", None, status=None, reason="timeout", body=None, partition_date=None),
        fetch(None, PAGE.format("anonymous")),
    ])


def test_land_then_rerun_then_change(spark, tmp_path, first):
    root = str(tmp_path)
    landed = landing.land(spark, first, root)
    assert outcomes(landed) == {"A-1": "inserted", "A-2": "inserted", "A-3": "inserted"}
    rows = metadata(spark, root)
    assert rows["A-2"].file_hash == hashlib.sha256(b"two, later").hexdigest()
    assert rows["A-3"].file_hash == hashlib.sha256(b"%PDF").hexdigest()
    assert rows["A-3"].file_path == "landing-zone/A-3.pdf"
    rejected = spark.read.parquet(f"{root}/{landing.QUARANTINE}").collect()
    assert {(r.identifier, r.error_code, r.error) for r in rejected} == {
        ("A-4", None, "no file content"), ("A-5", 503, "HTTP 503"), ("A-6", 0, "timeout"),
        (None, None, "identifier missing"),
    }

    again = landing.land(spark, first, root)
    assert set(outcomes(again).values()) == {"unchanged"}
    assert spark.read.parquet(f"{root}/{landing.CONTENT}/batch=1").count() == 0

    # Markup noise only: nothing new. New text, and a move to another month: updated.
    noise = PAGE.format("one").replace("<body>", "<body><script>x()</script>")
    second = frame(spark, [
        fetch("A-1", noise, at=9),
        fetch("A-2", PAGE.format("two, later"), month="2024-03", at=9),
        fetch("A-3", "%PDF2", kind="application/pdf", month="2024-02", at=9),
    ])
    third = landing.land(spark, second, root)
    assert outcomes(third) == {"A-1": "unchanged", "A-2": "updated", "A-3": "updated"}
    written = spark.read.parquet(f"{root}/{landing.CONTENT}/batch=2").collect()
    assert [(r.file_name, bytes(r.content)) for r in written] == [("A-3.pdf", b"%PDF2")]
    january = transforming.read_landed(spark, root, "2024-01-01", "2024-01-31").collect()
    assert [r.identifier for r in january] == ["A-1"]
    assert metadata(spark, root)["A-2"].partition_date == "2024-03"


@pytest.mark.parametrize("move_content", [False, True])
def test_compaction_keeps_everything(spark, tmp_path, first, move_content):
    root = str(tmp_path)
    landing.land(spark, first, root)
    transforming.transform(spark, root, "2024-01-01", "2024-01-31")
    landing.land(spark, frame(spark, [
        fetch("A-1", PAGE.format("new"), at=9), fetch("A-2", PAGE.format("two, later"), month="2024-03", at=9),
    ]), root)
    before = metadata(spark, root), objects(spark, root)
    base = landing.compact(spark, root, move_content)
    assert RunLog(spark, f"{root}/{landing.RUNS}").state() == [base]
    assert (metadata(spark, root), objects(spark, root)) == before
    gone = landing.remove_superseded(spark, root)
    assert gone == ([0, 1] if move_content else [base])
    assert (metadata(spark, root), objects(spark, root)) == before
    late = landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("old"), at=2)]), root)
    assert outcomes(late) == {"A-1": "kept"}
    run = transforming.transform(spark, root, "2024-01-01", "2024-03-31")
    assert run.summary.first().asDict() == dict(total_records=3, transformed=2, skipped=1, errors=0)


def test_late_arrivals_lose(spark, tmp_path):
    root = str(tmp_path)
    landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("last"), at=9, month="2024-02")]), root)
    late = landing.land(spark, frame(spark, [
        fetch("A-1", PAGE.format("first"), at=1), fetch("A-2", PAGE.format("x"), at=1)]), root)
    assert outcomes(late) == {"A-1": "kept", "A-2": "inserted"}
    assert metadata(spark, root)["A-1"].partition_date == "2024-02"
    assert b"last" in objects(spark, root)["A-1.html"]
    # The same content again, later: what comes between the two must still lose.
    landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("last"), at=30, month="2024-02")]), root)
    between = landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("between"), at=20)]), root)
    assert outcomes(between) == {"A-1": "kept"}
    assert b"last" in objects(spark, root)["A-1.html"]
    assert transforming.read_landed(spark, root, "2024-01-01", "2024-01-31").count() == 1


@pytest.mark.parametrize("written", [1, 2, 3])
def test_lost_run_leaves_nothing(spark, tmp_path, first, written):
    """A run that is lost after so many of its tables is as if it had never been."""
    root = str(tmp_path)
    lost = RunLog(spark, f"{root}/{landing.RUNS}").claim()
    other = frame(spark, [fetch("A-1", PAGE.format("lost"), at=50), fetch("Z-1", PAGE.format("z"), at=50)])
    items = landing.landing_items(other)
    tables = [
        (landing.object_content(other), landing.CONTENT, None),
        (items.select("file_name", "file_hash", F.lit(lost).alias("content_batch"), *landing.ARRIVAL), landing.INDEX, None),
        (landing.records_to_merge(items).withColumn(DELETED, F.lit(False)), landing.METADATA, "partition_date"),
    ]
    for rows, name, part in tables[:written]:
        append_batch(rows, f"{root}/{name}", lost, part)
    landing.land(spark, first, root)
    run = transforming.transform(spark, root, "2024-01-01", "2024-02-01")
    assert run.summary.first().asDict() == dict(total_records=3, transformed=3, skipped=0, errors=0)
    assert set(metadata(spark, root)) == {"A-1", "A-2", "A-3"}
    assert b"one" in objects(spark, root)["A-1.html"]
    assert spark.read.parquet(f"{root}/{transforming.CONTENT}").count() == 3


def month_scans(spark, root):
    """identifier -> months in which a scan of that month alone finds it."""
    found = {}
    for month in ("2024-01", "2024-02", "2024-03"):
        for r in transforming.read_landed(spark, root, f"{month}-01", f"{month}-28").collect():
            found.setdefault(r.identifier, []).append((r.partition_date, r.title))
    return found


@pytest.mark.parametrize("newer_first", [True, False])
@pytest.mark.parametrize("compact_between", [0, 1, 2])
def test_writers_that_do_not_know_of_each_other(spark, tmp_path, newer_first, compact_between):
    """Two versions of a record in different months: the later arrival counts, in every scan."""
    root = str(tmp_path)
    landing.land(spark, frame(spark, [fetch("A-1", "first", month="2024-01", at=1, title="first")]), root)
    older, newer = landing.LandingRun(spark, root), landing.LandingRun(spark, root)
    older.write(frame(spark, [fetch("A-1", "older", month="2024-03", at=2, title="older")]))
    newer.write(frame(spark, [fetch("A-1", "newer", month="2024-02", at=3, title="newer")]))
    runs = [newer, older] if newer_first else [older, newer]
    for k, run in enumerate(runs):
        if compact_between == 2 - k:
            landing.compact(spark, root)
        run.commit()
    assert month_scans(spark, root) == {"A-1": [("2024-02", "newer")]}
    landing.compact(spark, root)
    assert month_scans(spark, root) == {"A-1": [("2024-02", "newer")]}
    assert b"newer" in objects(spark, root)["A-1.html"]


def test_run_committed_after_a_base_stays(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    late, early, base = log.claim(), log.claim(), log.claim()
    log.commit(early)
    log.commit(base, replaces=[early])
    log.commit(late)
    assert log.state() == [late, base] and log.committed() == [late, early, base]
    other = log.claim()
    log.commit(other, replaces=[base])
    assert log.state() == [late, other]


def test_open_runs_keep_what_they_may_need(spark, tmp_path, first):
    root = str(tmp_path)
    landing.land(spark, first, root)
    run = landing.LandingRun(spark, root)
    landing.compact(spark, root, move_content=True)
    assert landing.remove_superseded(spark, root) == []
    run.write(first)
    run.commit()
    assert set(objects(spark, root)) == {"A-1.html", "A-2.html", "A-3.pdf"}
    lost = landing.LandingRun(spark, root)
    landing.compact(spark, root, move_content=True)
    assert landing.remove_superseded(spark, root, give_up=True)
    assert set(objects(spark, root)) == {"A-1.html", "A-2.html", "A-3.pdf"}
    with pytest.raises(ValueError):
        lost.commit()


def test_changes_read_only_new_runs(spark, tmp_path, first):
    root = str(tmp_path)
    landing.land(spark, first, root)
    run = transforming.transform_changes(spark, root)
    assert run.summary.first().asDict() == dict(total_records=3, transformed=3, skipped=0, errors=0)
    assert transforming.transform_changes(spark, root).summary.count() == 0
    open_run = landing.LandingRun(spark, root)
    landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("new"), at=9)]), root)
    open_run.write(frame(spark, [fetch("A-1", PAGE.format("older"), at=7), fetch("A-8", PAGE.format("8"), month="2024-03")]))
    assert transforming.unread_runs(spark, root) == ([2], [2])
    files = landing.landed_history(spark, root, [2]).inputFiles()
    assert files and all("batch=2/" in f for f in files)
    run = transforming.transform_changes(spark, root)
    assert outcomes(run) == {"A-1": "transformed"}
    # Committed later: its older version loses, its new record is found.
    open_run.commit()
    assert transforming.unread_runs(spark, root) == ([1], [1])
    transforming.transform_changes(spark, root)
    stored = {r.identifier: r.file_hash for r in transforming.transformed_rows(spark, root).collect()}
    content = b'<div class="content"><p>new</p></div>'
    assert set(stored) == {"A-1", "A-2", "A-3", "A-8"} and stored["A-1"] == hashlib.sha256(content).hexdigest()
    january = transforming.transform(spark, root, "2024-01-01", "2024-03-31")
    assert january.summary.first().asDict() == dict(total_records=4, transformed=0, skipped=4, errors=0)


def test_changes_after_compaction_and_after_errors(spark, tmp_path, first):
    """Rows of runs that are gone come from their base; failed records are tried again."""
    root = str(tmp_path)
    landing.land(spark, first, root)
    landing.compact(spark, root, move_content=True)
    landing.land(spark, frame(spark, [fetch("B-1", PAGE.format("b"), description=None, at=7)]), root)
    landing.remove_superseded(spark, root)
    assert transforming.unread_runs(spark, root) == ([0, 1, 2], [1, 2])
    run = transforming.transform_changes(spark, root)
    assert run.summary.first().asDict() == dict(total_records=4, transformed=3, skipped=0, errors=1)
    again = transforming.transform_changes(spark, root)
    assert outcomes(again) == {"B-1": "error"}
    landing.land(spark, frame(spark, [fetch("B-1", PAGE.format("b"), at=8)]), root)
    assert outcomes(transforming.transform_changes(spark, root)) == {"B-1": "transformed"}
    assert transforming.transform_changes(spark, root).summary.count() == 0


def test_two_writers_never_share_a_number(spark, tmp_path):
    log, other = (RunLog(spark, str(tmp_path / "runs")) for _ in range(2))
    assert [log.claim(), other.claim(), log.claim()] == [0, 1, 2]
    other.commit(1, "x")
    assert log.has("x") and log.committed() == [1]
    with pytest.raises(ValueError):
        log.commit(1, "x")


def test_fetch_id_must_be_unique(spark, tmp_path):
    twice = frame(spark, [fetch("A-1", "a", fetch_id="1"), fetch("A-2", "b", fetch_id="1")])
    with pytest.raises(ValueError):
        landing.land(spark, twice, str(tmp_path))


def test_transform_reads_only_the_content_it_wants(spark, tmp_path, first):
    root = str(tmp_path)
    for k in range(3):
        landing.land(spark, frame(spark, [fetch(f"A-{k}", PAGE.format(k))]), root)
    index = landing.current_objects(landing.landed_index(spark, root)).where("file_name = 'A-1.html'")
    content = landing.content_of(spark, root, index)
    files = [f for f in content.inputFiles() if landing.CONTENT in f]
    assert files and all("batch=1/" in f for f in files)
    plan = content._jdf.queryExecution().executedPlan().toString()
    assert all("content#" not in line for line in plan.split("\n") if "Exchange hashpartitioning" in line)


def scanned_rows(spark, df, column):
    """Rows that the file scans with a column hand on, and the plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans if column in s.toString()), plan.toString()


def test_few_names_read_few_rows(spark, tmp_path):
    """Names lie scattered over the files of a batch; a few of them are read from the files that have them."""
    root = str(tmp_path)
    fetches = spark.range(8000).repartition(16, F.hash("id")).select(
        F.format_string("A-%d", (F.col("id") * 7919) % 8000).alias("identifier"), *[
            F.lit("x").alias(c) for c in FETCHES.names[1:7]], F.lit("2024-01").alias("partition_date"),
        F.lit(None).cast("string").alias("reason"), F.lit("application/pdf").alias("content_type"),
        F.col("id").cast("string").alias("fetch_id"), F.lit(1).cast("bigint").alias("page"), F.lit(0).alias("position"),
        F.lit(200).alias("status"), F.col("id").cast("string").cast("binary").alias("content"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("fetched_at"),
    )
    landing.land(spark, fetches, root)
    index = landing.current_objects(landing.landed_index(spark, root))
    few = index.where("file_name IN ('A-17.pdf', 'A-4444.pdf')").select("file_name", "content_batch")
    content = landing.content_of(spark, root, few)
    files = spark.read.parquet(f"{root}/{landing.CONTENT}")
    assert len(files.inputFiles()) >= 16
    assert scanned_rows(spark, content, "content#")[0] <= 2 * 8000 / 16 * 1.5
    assert {r.file_name for r in content.collect()} == {"A-17.pdf", "A-4444.pdf"}
    many = index.select("file_name", "content_batch")
    assert landing.content_of(spark, root, many).count() == 8000
    none = index.where("file_name = 'B'").select("file_name", "content_batch")
    assert landing.content_of(spark, root, none).count() == 0

    # State is looked up by buckets: a few keys open the buckets that may have them, and
    # whatever comes in, state itself is not moved.
    landing.land(spark, fetches.where("identifier < 'A-3'").withColumn("fetched_at", F.expr("fetched_at + interval 1 hour")), root)
    history = landing.landed_history(spark, root)
    one = index.where("file_name = 'A-17.pdf'").select(F.lit("A-17").alias("identifier"))
    rows, _ = scanned_rows(spark, stored_rows_of(history, one, "identifier"), "partition_date#")
    assert 0 < rows <= 2 * 8000 / STATE_BUCKETS * 1.5
    all_of_them = fetches.select("identifier")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, plan = scanned_rows(spark, stored_rows_of(history, all_of_them, "identifier"), "partition_date#")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows > 8000 and "SortMergeJoin" in plan and f"SelectedBucketsCount: {STATE_BUCKETS} out of" in plan
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("partition_date" in line or "doc_url" in line for line in moved)
    exchanged = [k for k, line in enumerate(plan.split("\n")) if "Exchange" in line]
    scans = [k for k, line in enumerate(plan.split("\n")) if "partition_date#" in line and "FileScan" in line]
    lines = plan.split("\n")
    depth = [line.index("FileScan") for line in (lines[k] for k in scans)]
    for k, d in zip(scans, depth):
        # The nearest operators above a scan of state, up to its join.
        above = lines[:k]
        join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line and line.index("SortMergeJoin") < d)
        assert not any(join < i < k and lines[i].index("Exchange") < d for i in exchanged)
    # A scan of one month skips the row groups of others.
    other = fetches.where("identifier like 'A-5%'").withColumn("partition_date", F.lit("2024-02"))
    landing.land(spark, other.withColumn("fetched_at", F.expr("fetched_at + interval 2 hours")), root)
    landing.compact(spark, root)
    february = transforming.read_landed(spark, root, "2024-02-01", "2024-02-28")
    assert february.count() == other.count()


def test_transform_is_incremental(spark, tmp_path, first):
    root = str(tmp_path)
    landing.land(spark, first, root)
    run = transforming.transform(spark, root, "2024-01-01", "2024-02-01")
    assert run.summary.first().asDict() == dict(
        total_records=3, transformed=3, skipped=0, errors=0
    )
    rows = {r.file_name: r for r in spark.read.parquet(f"{root}/{transforming.CONTENT}").collect()}
    assert bytes(rows["A-1.html"].content) == b'<div class="content"><p>one</p></div>'
    assert bytes(rows["A-3.pdf"].content) == b"%PDF"
    meta = spark.read.parquet(f"{root}/{transforming.METADATA}").where("identifier = 'A-1'").first()
    assert meta.file_path == "transformed-zone/A-1.html"
    assert meta.file_hash == hashlib.sha256(bytes(rows["A-1.html"].content)).hexdigest()
    assert meta.source_hash == metadata(spark, root)["A-1"].file_hash

    again = transforming.transform(spark, root, "2024-01-01", "2024-02-01")
    assert again.summary.first().asDict() == dict(
        total_records=3, transformed=0, skipped=3, errors=0
    )
    landing.land(spark, frame(spark, [fetch("A-1", PAGE.format("new"), at=9)]), root)
    third = transforming.transform(spark, root, "2024-01-01", "2024-02-01")
    assert third.summary.first().asDict() == dict(
        total_records=3, transformed=1, skipped=2, errors=0
    )
    assert transforming.transform(spark, root, "2020-01-01", "2020-02-01").summary.count() == 0


def test_totals_taken_while_writing(spark, tmp_path, first):
    """Numbers of a run equal those of its tables, and do not read them again."""
    landed = landing.land(spark, first, str(tmp_path))
    failed, error = F.col("failed"), F.col("error").isNotNull()
    again = landed.items.agg(F.count_if(~failed), F.count_if(failed), F.count_if(~failed & error)).first()
    assert list(landed.totals.values()) == list(again) == [6, 2, 2]
    run = transforming.transform(spark, str(tmp_path), "2024-01-01", "2024-02-01")
    assert run.summary.first() == accounting.transform_summary(run.outcomes).first()
    assert "FileScan" not in run.summary._jdf.queryExecution().executedPlan().toString()


def test_unreadable_lines_are_kept(spark, tmp_path):
    lines = ['{"event": "a", "error_code": 1}', "", "  ", "[]", "[1]", "5", "null", '"text"', '{"event": "b"', "{}",
             '{"event": "c", "error_code": "x"}', '{"event": {"no": 1}, "error_code": 2}', "\x00", '{"other": 1}']
    path = str(tmp_path / "log")
    write_events(spark.createDataFrame([(t,) for t in lines], "value string"), path)
    events = read_events(spark, path, "event string, error_code int").collect()
    broken = [r.value for r in unreadable_lines(spark, path, "event string, error_code int").collect()]
    assert len(events) + len(broken) == sum(bool(t.strip(" ")) for t in lines)
    assert ("a", 1) in [tuple(r) for r in events] and not any(r.event == "c" for r in events)
    assert {"[]", "5", '{"event": "b"', '{"event": "c", "error_code": "x"}', '"text"'} <= set(broken)


def test_transform_errors_are_counted(spark, tmp_path, first):
    root = str(tmp_path)
    landing.land(spark, first, root)
    broken = frame(spark, [fetch("B-1", PAGE.format("b"), description=None, at=7)])
    landing.land(spark, broken, root)
    orphan = landing.landed_records(spark, root).limit(1).withColumns({
        "identifier": F.lit("B-2"), "file_path": F.lit("landing-zone/B-2.html"), DELETED: F.lit(False)})
    log = RunLog(spark, f"{root}/{landing.RUNS}")
    number = log.claim()
    append_batch(orphan, f"{root}/{landing.METADATA}", number, "partition_date")
    append_batch(landing.landed_index(spark, root).limit(0).drop("batch"), f"{root}/{landing.INDEX}", number)
    log.commit(number)
    run = transforming.transform(spark, root, "2024-01-01", "2024-02-01")
    errors = {r.identifier: r.error for r in run.outcomes.where("outcome = 'error'").collect()}
    assert errors == {"B-1": "missing: description", "B-2": "content not found"}
    assert run.summary.first().errors == 2
    lines = reporting.transform_events(
        run.outcomes, run.summary, "2024-01-01", "2024-02-01", "docs",
        F.lit("2024-05-01 10:00:00.25").cast("timestamp_ntz"),
    )
    write_events(lines, f"{root}/events")
    events = read_events(spark, f"{root}/events", EVENTS)
    assert {r.event: r.n_events for r in event_counts(events).collect()} == {
        "fetch_metadata": 1, "transform_success": 3, "transform_error": 1, "download_failed": 1,
        "transform_summary": 1,
    }
    lost = events.where("event = 'download_failed'").first()
    assert (lost.object_name, lost.error, lost.level) == ("B-2.html", "content not found", "ERROR")
    assert lost.timestamp == "2024-05-01T10:00:00.250000+00:00"
    run.staging.discard()


def test_report(spark, tmp_path, first):
    card = '<li class="each-item"><h2 class="title" title="X">t</h2></li>'
    plan = spark.createDataFrame([("2024-01", "A"), ("2024-02", "A"), ("2024-03", "A")],
                                 "partition string, body string")
    results = spark.createDataFrame(
        [("2024-01", "A", 1, "http://h/", f"<ul>{card * 4}</ul>"),
         ("2024-02", "A", 1, "http://h/", f"<ul>{card * 2}</ul>")],
        "partition string, body string, page bigint, page_url string, html string",
    )
    items = landing.landing_items(first)
    counts = reporting.report_counts(plan, results, items)
    summary = [tuple(r) for r in accounting.partition_summary(counts).collect()]
    assert summary == [("2024-01", "A", 4, 4, 1, -1), ("2024-02", "A", 2, 2, 0, 0),
                       ("2024-03", "A", 0, 0, 0, 0)]
    totals = accounting.run_summary(counts).first()
    assert tuple(totals) == (3, 6, 6, 1, 1)
    lines = reporting.report_events(
        counts, reporting.failures_of(items), "docs", F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    )
    path = log_path(str(tmp_path), "docs", datetime(2024, 5, 1, 10), "r1")
    assert path.endswith("/docs_20240501_100000_r1.json")
    write_events(lines, path)
    events = read_events(spark, path, EVENTS)
    assert {r.event: r.n_events for r in event_counts(events).collect()} == {
        "partition_start": 3, "download_failed": 2, "partition_end": 3,
        "partition_failures": 2, "run_summary": 1,
    }
    first_line = json.loads(spark.read.text(path).where("value like '%run_summary%'").first().value)
    assert first_line["timestamp"] == "2024-05-01T10:00:00+00:00"
    assert first_line["total_records_found"] == 6


def test_stream_equals_batch(spark, tmp_path, first):
    source = tmp_path / "in"
    for i in range(3):
        part = first.withColumn("identifier", F.concat(F.col("identifier"), F.lit(f"-{i}")))
        part.drop("fetch_id").coalesce(1).write.mode("append").parquet(str(source))
    root = str(tmp_path / "stream")
    query = land_stream(arriving_fetches(spark, str(source), 1), root, str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.exception() is None
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FETCHES if f.name != "fetch_id")
    whole = spark.read.schema(schema).parquet(str(source)).withColumn(
        "fetch_id", F.expr("concat(_metadata.file_path, '#', _metadata.row_index)")
    )
    batch_root = str(tmp_path / "batch")
    landing.land(spark, whole, batch_root)
    assert len(list((tmp_path / "stream" / landing.METADATA).glob("batch=*"))) == 3
    assert metadata(spark, root) == metadata(spark, batch_root)


def test_stream_adds_to_what_is_there(spark, tmp_path, first):
    """A new checkpoint, and a lost one, never replace landed records; late files lose."""
    root, source = str(tmp_path / "root"), tmp_path / "in"
    landing.land(spark, first, root)
    arriving = frame(spark, [fetch("S-1", PAGE.format("s")), fetch("A-1", PAGE.format("older"), at=0),
                             fetch("A-3", PAGE.format("newer"), at=40)])
    arriving.drop("fetch_id").coalesce(1).write.parquet(str(source))
    for checkpoint in ("c1", "c2"):
        query = land_stream(arriving_fetches(spark, str(source)), root, str(tmp_path / checkpoint), compact_every=1)
        query.awaitTermination()
        assert query.exception() is None
        assert set(metadata(spark, root)) == {"A-1", "A-2", "A-3", "S-1"}
        assert b"one" in objects(spark, root)["A-1.html"] and b"newer" in objects(spark, root)["A-3.html"]


def test_micro_batch_is_landed_once(spark, tmp_path, first):
    root = str(tmp_path)
    landing.land(spark, first, root, "stream-0")
    log = RunLog(spark, f"{root}/{landing.RUNS}")
    assert log.has("stream-0") and not log.has("stream-1")
