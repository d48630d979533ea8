import io
import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from stagewatch import sinks
from stagewatch.functions import scratch
from stagewatch.operators import diagnostics, enrich, normalize, versions
from stagewatch.plans import written
from stagewatch.plans.queries import QUERIES
from stagewatch.plans.site_run import SiteRun
from stagewatch.sources import case_files, listing, sheets, tables


def database(rows, segment="SegmentId", audit=True) -> bytes:
    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE Other (a TEXT)")
    if audit:
        db.execute(f"CREATE TABLE AuditLogRecords (Id INTEGER PRIMARY KEY, TimeStamp TEXT, AuditRecordBase_Type TEXT, {segment} TEXT, EventKind INTEGER)")
        db.executemany("INSERT INTO AuditLogRecords VALUES (?, ?, ?, ?, ?)", [(i, *r) for i, r in enumerate(rows, 1)])
        db.execute("CREATE TABLE Sessions (Id INTEGER, TimePatientSedatedAt TEXT)")
        db.execute("INSERT INTO Sessions VALUES (1, '2025-01-01 08:30:00')")
    return db.serialize()


ROWS = [("2025-01-01 09:00:00.0000000", "SetupWorkflowRecord", "2025-01-01_x", 1),
        ("2025-01-01 09:10:00.0000000", "CoarseWorkflowRecord", "", None)]


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("cases")

    def put(path, content):
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)

    def archive(members):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for name, content in members:
                z.writestr(name, content)
        return buffer.getvalue()

    put("S1/plain/local.db", database(ROWS))
    put("S1/Older/_s1/local.db", database(ROWS, segment="TreatmentId"))
    put("S1/zipped/Session1.zip", archive([("nested/local.db", database(ROWS)), ("readme.txt", b"x")]))
    put("S1/hollow/Session1.zip", archive([("readme.txt", b"x")]))
    put("S1/twice/a/_x/local.db", database(ROWS))
    put("S1/twice/b/_x/local.db", database(ROWS))
    put("S1/broken/local.db", database([], audit=False))
    put("S1/none/notes.txt", b"x")
    (root / "S1" / "bare").mkdir()
    put("S1/TimingLogs/plain.csv", "﻿x,Events,TimeSTART,TimeEND\r\n1,Devices Insertion,2025-01-01 08:00:00,2025-01-01 08:20:00\r\n,,,\r\n".encode())
    put("S1/TimingLogs/Older.csv", b'a,b,c,d,e\n1,2,"Patient is ready, ""now""",,2025-01-01 08:00:00\n')
    put("S1/TimingLogs/zipped.csv", b"A,B\n1,2\n")
    put("S1/TimingLogs/twice.csv", b"Events,TimeSTART,TimeEND\nonly\n")
    put("S1/TimingLogs/hollow.csv", b"Events,TimeSTART,TimeEND\n")
    put("S1/TimingLogs/a+b c.csv", b"")
    return root


@pytest.fixture(scope="module")
def resolved(spark, tree):
    cases = listing.discover_cases(listing.list_files(spark, str(tree)))
    return listing.resolve_sources(cases, zip_members=case_files.zip_members(cases, str(tree))).cache()


def test_discovery_and_resolution(resolved):
    got = {r.case_id: r for r in resolved.collect()}
    assert [r.case_id for r in sorted(got.values(), key=lambda r: r.discovery_order)] == [
        "bare", "broken", "hollow", "none", "Older", "plain", "twice", "zipped"]
    assert {c: r.status for c, r in got.items()} == {
        "bare": "no_candidates", "broken": "resolved", "hollow": "not_found", "none": "no_candidates", "Older": "resolved", "plain": "resolved",
        "twice": "ambiguous", "zipped": "resolved"}
    assert got["zipped"].zip_member == "nested/local.db" and got["zipped"].resolution_rule == "zip_precedence"
    assert got["twice"].warnings == ["multiple_unzipped_database_candidates"]
    assert got["hollow"].warnings[0].startswith("zip_without_localdb:")


def test_index_and_first_policies(spark, tree):
    cases = listing.discover_cases(listing.list_files(spark, str(tree))).filter("case_id = 'twice'")
    second = listing.resolve_sources(cases, allow_ambiguous=True, candidate_index=1).first()
    assert second.source_path.endswith("b/_x/local.db") and len(second.ambiguous_candidates) == 1
    assert listing.resolve_sources(cases, allow_ambiguous=True, candidate_index=5).first().status == "ambiguous"
    assert listing.resolve_sources(cases, policy="first").first().source_path.endswith("a/_x/local.db")
    roster = spark.createDataFrame([("S1", "empty"), ("S1", "twice")], "site_code string, case_id string")
    assert listing.discover_cases(listing.list_files(spark, str(tree)).filter("case_id = 'twice'"), roster).count() == 2


def test_case_files_end_to_end(spark, tree, resolved, tmp_path):
    rows = case_files.land(case_files.case_rows(resolved, str(tree)), str(tmp_path / "landed"))
    raw, sessions = case_files.audit_events(rows), case_files.session_rows(rows)
    assert {r.case_id: r["count"] for r in raw.groupBy("case_id").count().collect()} == {"plain": 2, "Older": 2, "zipped": 2}
    assert {r.raw_segment_id for r in raw.filter("row_number = 1").collect()} == {"2025-01-01_x"}
    errors = case_files.read_errors(rows)
    assert [(r.case_id, "missing table" in r.error) for r in errors.collect()] == [("broken", True)]
    tables_found = case_files.catalog(rows).filter("path LIKE '%plain%'").orderBy("table_name").collect()
    assert [(t.table_name, t.n_rows) for t in tables_found] == [("AuditLogRecords", 2), ("Other", 0), ("Sessions", 1)]

    run = SiteRun(raw, sessions)
    states = {r.event_type: r.state for r in run.labelled.filter("case_id = 'plain'").collect()}
    assert states == {"Ready4Urology": "Patient positioning & induction", "SetupWorkflowRecord": "TULSA QA", "CoarseWorkflowRecord": "Coarse"}
    out = sinks.with_payload(run.intervals, run.enrich(with_payload=True))
    assert out.filter("raw_payload IS NULL").count() == 0
    twice = SiteRun(raw, sessions.unionByName(sessions.withColumn("row_number", F.col("row_number") + 1)))
    indexes = sinks.with_payload(twice.labelled, twice.enrich(with_payload=True)).filter("source = 'sessions' AND case_id = 'plain'").select(
        F.get_json_object("raw_payload", "$.session_row_index").alias("i"))
    assert {r.i for r in indexes.collect()} == {"1", "2"}
    sinks.write_events(out, str(tmp_path / "intervals"), sinks.INTERVALS, per_case=True)
    back = spark.read.parquet(str(tmp_path / "intervals"))
    assert set(back.columns) == {"site_code", *sinks.INTERVALS} and back.count() == 9
    sinks.write_events(run.labelled.withColumn("raw_payload", F.lit("{}")), str(tmp_path / "labelled"), sinks.STATE_LABELED, form="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "labelled")).count() == 9


def test_manifest_documents(spark, resolved, tree, tmp_path):
    manifest = sinks.case_manifest(listing.discover_cases(listing.list_files(spark, str(tree))))
    assert manifest.columns == sinks.CASE_MANIFEST
    counts = spark.createDataFrame([("S1", 3, 1)], "site_code string, cases_discovered bigint, cases_failed bigint")
    sinks.write_documents(sinks.manifest_document(counts, "r1", "t0", "t1", {"intervals": "/x"}), str(tmp_path / "run"))
    document = spark.read.json(str(tmp_path / "run")).first().document
    assert '"run_id":"r1"' in document and '"artifact_paths":{"intervals":"/x"}' in document


def test_sheets_of_a_site(spark, tree):
    lines, files = sheets.sheet_lines(spark, str(tree)), sheets.sheet_files(spark, str(tree))
    rows = {r.case_id: r for r in sheets.sheet_rows(lines).collect()}
    assert set(rows) == {"plain", "Older"} and {r.site_code for r in rows.values()} == {"S1"}
    assert rows["Older"].label == 'Patient is ready, "now"' and rows["Older"].end_text == "2025-01-01 08:00:00"
    assert [(r.case_id, r.row_number, r.detail) for r in sheets.blank_row_warnings(lines).collect()] == [("plain", 3, "plain.csv")]
    assert {r.case_id: (r.error, r.row_number) for r in sheets.sheet_errors(lines, files).collect()} == {
        "zipped": (sheets.NO_COLUMNS, 1), "twice": (sheets.SHORT_ROW, 2), "hollow": (sheets.HEADER_ONLY, 1), "a+b c": (sheets.EMPTY, 1)}
    events = enrich.timing_log_events(sheets.sheet_rows(lines)).orderBy("timestamp").collect()
    assert [e.event_type for e in events] == ["DeviceInsertionBegins", "DeviceInsertionEnds"]
    cases = spark.createDataFrame([("S1", c) for c in ("plain", "none", "a+b c")], "site_code string, case_id string")
    found = {r.case_id: (r.source_file is not None, r.n_entries, r.n_blank, r.error) for r in sheets.case_sheets(cases, files, lines).collect()}
    assert found == {"plain": (True, 1, 1, None), "none": (False, 0, 0, None), "a+b c": (True, None, None, sheets.EMPTY)}


def test_line_numbers_go_on_over_the_splits_of_a_file(spark, tmp_path):
    folder = tmp_path / "S2" / "TimingLogs"
    folder.mkdir(parents=True)
    names = [f"step {i}" for i in range(5000)]
    (folder / "long.csv").write_text("Events,TimeSTART,TimeEND\n" + "".join(f"{n},,x\n" for n in names))
    (folder / "short.csv").write_text("Events,TimeSTART,TimeEND\nonly,,x\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = sheets.sheet_lines(spark, str(tmp_path))
        got = sorted((r.case_id, r.row_number, r.label) for r in sheets.sheet_rows(lines).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("long", i + 2, n) for i, n in enumerate(names)] + [("short", 2, "only")]


def _sheet_results(cases, files, lines):
    shown = {
        "lines": lines.select("site_code", "case_id", "line_number", F.to_json("cells").alias("cells")), "rows": sheets.sheet_rows(lines).drop("source_file"),
        "files": files.drop("source_file"), "errors": sheets.sheet_errors(lines, files), "blank": sheets.blank_row_warnings(lines),
        "cases": sheets.case_sheets(cases, files, lines).drop("source_file"),
    }
    return {name: sorted((tuple(r) for r in df.collect()), key=str) for name, df in shown.items()}


def test_landed_sheets_are_read_like_their_files(spark, tree, tmp_path):
    path = str(tmp_path / "landed")
    sheets.land_sheets(spark, str(tree), path)
    cases = spark.createDataFrame([("S1", c) for c in ("plain", "Older", "twice", "none", "a+b c")], "site_code string, case_id string")
    from_files = _sheet_results(cases, sheets.sheet_files(spark, str(tree)), sheets.sheet_lines(spark, str(tree)))
    from_table = _sheet_results(cases, sheets.sheet_files(spark, path, landed=True), sheets.sheet_lines(spark, path, landed=True))
    assert from_table == from_files and len(from_table["files"]) == 6 and len(from_table["lines"]) == 10


def test_lines_of_landed_sheets_end_as_those_of_files(spark, tmp_path):
    texts = {"a": "h\r\n\r\nx\ry\n\n", "b": "no end", "c": "\n", "d": "", "e": "\r\r\n\r"}
    folder, path = tmp_path / "tree" / "S1" / "TimingLogs", str(tmp_path / "landed")
    folder.mkdir(parents=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    sheets.land_sheets(spark, str(tmp_path / "tree"), path)

    def shown(lines):
        return sorted((r.case_id, r.line_number, tuple(r.cells)) for r in lines.collect())

    assert shown(sheets.sheet_lines(spark, path, landed=True)) == shown(sheets.sheet_lines(spark, str(tmp_path / "tree")))


def test_line_numbers_go_on_over_the_blocks_of_a_landed_sheet(spark, tmp_path):
    path, sheet = str(tmp_path / "landed"), "S1/TimingLogs/a.csv"
    blocks = [(sheet, 7, "two,,x\nthree,,x\n"), (sheet, 0, "Events,TimeSTART,TimeEND\none,,x\n"), (sheet, 1 << 33, "four,,x"), ("S1/notes.txt", 0, "x\n")]
    spark.createDataFrame(blocks, sheets.LANDED).repartition(4).write.parquet(path)
    lines = sheets.sheet_lines(spark, path, landed=True)
    assert sorted((r.row_number, r.label) for r in sheets.sheet_rows(lines).collect()) == [(2, "one"), (3, "two"), (4, "three"), (5, "four")]
    assert [tuple(r) for r in sheets.sheet_files(spark, path, landed=True).collect()] == [("S1", "a", sheet, sum(len(b[2]) for b in blocks[:3]))]


def test_written_sheets_need_no_file_per_case(spark, tmp_path, monkeypatch):
    first = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(2), F.lit(8), F.lit(0), F.lit(0))
    spark.range(300).select(
        F.col("id").alias("event_id"), first.alias("ts"), F.col("id").alias("user_id"), F.lit("x").alias("event_type"), F.lit(0.0).alias("value"),
        F.lit('{"k": 1}').alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    made = []
    monkeypatch.setattr(written, "new_path", lambda _, name: made.append(tmp_path / name) or str(tmp_path / name))
    files, _ = written.written_sheets(spark, str(tmp_path))
    assert files.count() == files.select("site_code", "case_id").distinct().count() == sum(i % 9 != 8 for i in range(300))
    assert len([p for p in made[0].rglob("part-*") if p.is_file()]) <= 32


@pytest.mark.parametrize("name", ["case_sheets", "sheet_rows", "sheet_warnings"])
def test_sheet_queries_write_no_file_per_case(spark, tmp_path, monkeypatch, name):
    first = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(2), F.lit(8), F.lit(0), F.lit(0))
    spark.range(540).select(
        F.col("id").alias("event_id"), first.alias("ts"), F.col("id").alias("user_id"), F.lit("x").alias("event_type"), F.lit(0.0).alias("value"),
        F.lit('{"k": 1}').alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path / "shared"))
    kinds = 60  # cases of each of the nine shapes
    rows = {"case_sheets": 9 * kinds, "sheet_rows": 5 * kinds * 6 + kinds * 5, "sheet_warnings": kinds}
    assert QUERIES[name](spark, str(tmp_path)).count() == rows[name]
    assert 0 < len([p for p in (tmp_path / "shared").rglob("part-*") if p.is_file()]) <= 64


def test_csv_cells_are_those_of_the_csv_module(spark):
    import csv

    texts = ['a,b', '', ',', '"a,b",c', '"a ""q"" b",', 'a"b,c', '"x"y,z', '""', '"",""', ' "a",b', 'é,"ü,ß"', '"' + "x" * 20_000 + '",y', '"' + '""' * 3000 + '"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", sheets.csv_cells(F.col("t")).alias("c")).collect()}
    assert got == {i: (next(csv.reader([t])) if t else []) for i, t in enumerate(texts)}


def test_rows_that_do_not_fit_are_found_whatever_is_asked_for(spark, tmp_path):
    (tmp_path / "a.csv").write_text("c,1,2024-01-01,x,7\nc,2,2024-01-01,x,many\nshort\nc,3,2024-01-01,x,1,more\n")
    (tmp_path / "b.csv").write_text("c,1,2024-01-01,,\n")
    rows = tables.read_checked(spark, str(tmp_path), "case_id string, n bigint, day date, kind string, seconds double", header=False)
    good, bad = tables.split_bad(rows)
    assert sorted(r.n for r in good.select("n").collect()) == [1, 1] and good.count() == 2
    assert sorted(r[tables.BAD_LINE][:7] for r in bad.collect()) == ["c,2,202", "c,3,202", "short"]
    assert sorted((r.source_file[-5:], r.n_rows, r.n_bad) for r in tables.bad_rows(rows).collect()) == [("a.csv", 4, 3), ("b.csv", 1, 0)]


def test_synonyms_and_lenient_numbers(spark):
    df = spark.createDataFrame([(" ", "p", "3.0"), ("q", None, "x")], "a string, b string, n string")
    assert [tuple(r) for r in tables.unified(df, {"who": ("z", "a", "b"), "many": ("n",)}, ("many",)).collect()] == [("p", 3), ("q", None)]
    with pytest.raises(ValueError):
        tables.unified(df, {"who": ("none",)})


def test_replacing_a_site_twice_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(spark.createDataFrame([("A", 1), ("B", 2)], "site_code string, n int"), path)
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([("A", 7), ("A", 8)], "site_code string, n int"), path)
    back = sinks.read_sites(spark, path, spark.read.parquet(path).schema)
    assert sorted(tuple(r) for r in back.select("site_code", "n").collect()) == [("A", 7), ("A", 8), ("B", 2)]
    one = sinks.read_sites(spark, path, back.schema, ["A"])
    assert "site_code" in one._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 2


def test_rows_of_an_ordered_table_are_found_by_position(spark, tmp_path):
    path = str(tmp_path / "ordered")
    numbers = [(i * 37) % 1000 for i in range(1000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, small as they are
    try:
        sinks.write_ordered(spark.createDataFrame([(n,) for n in numbers], "n int").repartition(7), path, ["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.position, r.n) for r in sinks.read_ordered(spark, path).collect()) == [(i, i) for i in range(1000)]
    some = sinks.read_ordered(spark, path, 260, 270)
    assert sorted((r.position, r.n) for r in some.collect()) == [(i, i) for i in range(260, 271)]
    files = sorted((r.first, r.n_rows) for r in sinks.ordered_files(spark, path).collect())
    assert len(files) > 1 and all(a + n == b for (a, n), (b, _) in zip(files, files[1:]))
    assert sinks.read_ordered(spark, path, 5000, 6000).collect() == []


def test_document_parts_are_bounded_and_in_order(spark, tmp_path):
    results = spark.createDataFrame([("A", i, f"c{i}") for i in range(1, 26)], "site_code string, discovery_order bigint, case_id string")
    manifest = spark.createDataFrame([("A", 25)], "site_code string, cases_discovered bigint")
    places = spark.createDataFrame([("A", "x", "out/x")], "site_code string, name string, path string")
    sinks.write_document_parts(sinks.document_parts(manifest, results, places, part_cases=10), str(tmp_path / "d"))
    parts = sorted(sinks.read_document_parts(spark, str(tmp_path / "d")).collect(), key=lambda r: r.part)
    assert [(r.part, r.kind) for r in parts] == [(0, "head"), (1, "cases"), (2, "cases"), (3, "cases")]
    document = json.loads(parts[0].body) | {"case_results": [c for r in parts[1:] for c in json.loads(r.body)]}
    assert document["artifact_paths"] == {"x": "out/x"} and [c["case_id"] for c in document["case_results"]] == [f"c{i}" for i in range(1, 26)]


def test_payloads_that_are_no_objects_have_no_columns(spark):
    rows = spark.createDataFrame([("S", "c", 1, '{"a": 1}'), ("S", "c", 2, '{"a": 2.5, "b": null}'), ("S", "c", 3, "no json"), ("S", "c", 4, None), ("S", "c", 5, "[1]")],
                                 "site_code string, case_id string, row_number bigint, raw_payload string")
    got = {(r["column"]): (r.type, r.n_rows, r.n_null) for r in versions.log_catalog(rows).collect()}
    assert got["a"][0].startswith("DECIMAL") and got["a"][1:] == (2, 0) and got["b"] == ("VOID", 1, 1) and len(got) == 2
    log = versions.unified_log(rows, {"n": ("int", ("a",)), "m": ("string", ("z", "b"))}).orderBy("row_number").collect()
    assert [(r.n, r.m) for r in log][0] == (1, None) and len(log) == 5


@pytest.mark.parametrize("wall, status, earlier, later", [
    ("2024-03-10 01:59:59", "unique", "06:59:59", "06:59:59"), ("2024-03-10 02:00:00", "gap", "07:00:00", None),
    ("2024-03-10 02:59:59", "gap", "07:59:59", None), ("2024-03-10 03:00:00", "unique", "07:00:00", "07:00:00"),
    ("2024-11-03 00:59:59", "unique", "04:59:59", "04:59:59"), ("2024-11-03 01:00:00", "overlap", "05:00:00", "06:00:00"),
    ("2024-11-03 01:59:59", "overlap", "05:59:59", "06:59:59"), ("2024-11-03 02:00:00", "unique", "07:00:00", "07:00:00"),
    ("2024-07-01 12:00:00", "unique", "16:00:00", "16:00:00"), ("soon", "bad", None, None)])
def test_clock_changes(spark, wall, status, earlier, later):
    df = spark.createDataFrame([(wall,)], "t string")
    zone = F.lit("America/New_York")
    first = normalize.local_instants(df, "t", zone, "ts", drop_bad=False).first()
    last = normalize.local_instants(df, "t", zone, "ts", overlap="later", gap="null", drop_bad=False).first()
    shown = lambda r: None if r.ts is None else str(r.ts)[11:19]
    assert (first.ts_status, shown(first), shown(last)) == (status, earlier, later)
    assert normalize.local_instants(df, "t", zone, "ts").count() == (status != "bad")


def test_ties_of_categories_go_by_first_sight(spark):
    rows = [("S", "b", "zeta", 9, None), ("S", "B2", "alpha", 1, None), ("S", "a", "plot_x", 1, None), ("S", "b", "zeta", 3, None),
            ("S", "c", "alpha", 1, None), ("S", "c", "plot_x", 2, None)]
    df = spark.createDataFrame(rows, "site_code string, case_id string, category string, row_number bigint, detail string")
    assert [r.category for r in diagnostics.top_warnings(df).orderBy("rank").collect()] == ["zeta", "alpha", "plot_x"]


def test_csv_table_with_explicit_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("site_code,case_id,row_number\nS1,c,7\n")
    row = tables.read_table(spark, str(tmp_path / "t.csv"), "site_code string, case_id string, row_number bigint").first()
    assert row.row_number == 7


RAW = "site_code string, case_id string, row_number bigint, raw_timestamp string, raw_event_type string, raw_segment_id string, raw_event_kind int, raw_payload string"


def raw(spark, rows):
    return spark.createDataFrame([("S", c, n, t, k, s, 0, p) for c, n, t, k, s, p in rows], RAW)


def test_one_bad_row_fails_its_case_only(spark):
    df = raw(spark, [("good", 1, "2025-01-01 09:00:00", " SetupWorkflowRecord ", " ", '{"TreatmentId": " t1 "}'),
                     ("good", 2, "2025-01-01 09:00:01", "SignalRecord", None, None),
                     ("bad", 1, "2025-01-01 09:00:00", "SetupWorkflowRecord", None, None),
                     ("bad", 2, "nope", "SetupWorkflowRecord", None, None), ("bad", 3, "2025-01-01 09:00:00", " ", None, None)])
    assert [(r.case_id, r.row_number, r.error) for r in normalize.case_errors(df).collect()] == [("bad", 2, "invalid_timestamp")]
    kept = normalize.kept(normalize.normalize_events(df)).collect()
    assert [(r.case_id, r.event_type, r.segment_id) for r in kept] == [("good", "SetupWorkflowRecord", "t1")]
    assert normalize.normalize_events(df, on_error="drop_row").count() == 3
    assert {r.case_id for r in SiteRun(df).intervals.collect()} == {"good"}


def test_merge_order_at_one_instant(spark):
    df = raw(spark, [("c", n, "2025-01-01 09:00:00", "SetupWorkflowRecord", None, None) for n in (2, 1)])
    sessions = spark.createDataFrame([("S", "c", 1, "2025-01-01 09:00:00")], "site_code string, case_id string, row_number bigint, TimePatientSedatedAt string")
    sheet = spark.createDataFrame([("S", "c", "c.csv", 2, "Devices Insertion", "2025-01-01 09:00:00", "")],
                                  "site_code string, case_id string, source_file string, row_number bigint, label string, start_text string, end_text string")
    run = SiteRun(df, sessions, sheet)
    rows = run.intervals.orderBy("pos").collect()
    assert [(r.source, r.row_number) for r in rows] == [("auditlog", 1), ("auditlog", 2), ("sessions", None), ("timing_log", None)]
    found = {(r.category, r.detail) for r in run.warnings.collect()}
    assert ("session_missing_column", "TimeUaRemovedAt") in found
    assert ("timing_log_missing_mapped_time", "Devices Insertion:DeviceInsertionEnds:end") in found


def test_years(spark):
    assert normalize.resolve_years("All", 2018) == [2016, 2017, 2018] and normalize.resolve_years("PastYears", 2018) == [2016, 2017]
    assert normalize.resolve_years("2020", 2018) == [2020] and normalize.resolve_years("CurrentYear", 2018) == [2018]
    with pytest.raises(ValueError):
        normalize.resolve_years("1800", 2018)


def test_identifier_inference(spark):
    df = raw(spark, [("c1", 1, "t", "k", None, None), ("c2", 1, "t", "k", None, None)]).withColumn("patient_id", F.lit(" "))
    sessions = spark.createDataFrame([("S", "c1", 1, "", "Doe")], "site_code string, case_id string, row_number bigint, PatientId string, LastName string")
    assert {r.case_id: r.inferred_id for r in normalize.infer_patient_ids(df, sessions).collect()} == {"c1": "Doe", "c2": "c2"}


def test_zone_reads_wall_clock_as_local(spark):
    df = spark.createDataFrame([("2025-01-01 09:00:00",), ("x",)], "t string")
    assert str(normalize.lenient_times(df, "t", "ts", zone="America/Los_Angeles").first().ts) == "2025-01-01 17:00:00"
    assert normalize.lenient_times(df, "t", "ts", drop_bad=False).count() == 2


def test_diagnostics_thresholds(spark):
    rows = [("S", "c", us * 1_000_000, [flag]) for us, flag in (
        (100, "negative_rebased_start"), (8001, "interval_truncated_large_gap"), (16000, "interval_terminal_state_clamped"),
        (40000, "interval_early_state_truncated"))]
    df = spark.createDataFrame(rows, "site_code string, case_id string, duration_us bigint, quality_flags array<string>")
    out = diagnostics.run_diagnostics(df).first()
    assert (out.n_over_7200, out.n_over_14400, out.n_over_28800, out.max_duration_sec) == (3, 2, 1, 40000.0)
    assert out.interval_early_state_truncated == 1 and out.interval_unassigned_state_truncated == 0
