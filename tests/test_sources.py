import datetime as dt

from docvec.plans import audit
from docvec.sources import documents as D


def test_uri_list_and_extraction(spark, tmp_path):
    good, page = tmp_path / "a b.txt", tmp_path / "page.html"
    good.write_text("plain text", encoding="utf-8")
    page.write_text("<html><body><p>Seen</p><script>no</script></body></html>", encoding="utf-8")
    uris = [good.as_uri(), str(page), str(tmp_path / "missing.txt"), "nowhere://x/y", str(tmp_path), good.as_uri()]
    listing = tmp_path / "uris.txt"
    listing.write_text("\n".join(uris) + "\n\n", encoding="utf-8")
    listed = D.uri_list(spark, str(listing), 1)
    assert listed.count() == 5
    assert listed.rdd.getNumPartitions() == max(5, spark.sparkContext.defaultParallelism)
    got = {r.uri: r.text for r in D.extract_uris(listed).collect()}
    assert got == dict(zip(uris, ["plain text", "Seen", "", "", ""]))
    failed = {r.uri: r.reason for r in D.extraction_failures(D.extract_uris(listed)).collect()}
    assert set(failed) == set(uris[2:5]) and failed[uris[2]].startswith("FileNotFoundError")


def test_null_uri_and_failing_extractor(spark):
    df = spark.createDataFrame([(None,), ("u",)], "uri string")
    got = [r.text for r in D.extract_uris(df, fetch=lambda u: u.encode(), extract=lambda b: 1 / 0).collect()]
    assert got == ["", ""]


def test_binary_files(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"one")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "y.bin").write_bytes(b"two")
    files = D.read_files(spark, str(tmp_path))
    rows = D.extract_files(files, lambda b: b.decode().upper()).collect()
    assert sorted(r.text for r in rows) == ["ONE", "TWO"]


def test_small_tables_are_spread(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    assert D.read_table(spark, str(tmp_path), "t", 4).rdd.getNumPartitions() == 4
    assert D.read_table(spark, str(tmp_path), "t").count() == 10


def test_audit_lines_and_log_file(spark, tmp_path):
    trail = audit.Audit("run1")
    trail.note("embed", "hello")
    trail.count("embed", "failed", 2)
    trail.note("run", "log only", channel="error")
    events = trail.table(spark)
    summary = {r.channel: r.entries for r in audit.audit_summary(events).collect()}
    assert summary == {"audit": 2, "error": 1}
    path = audit.write_log(events, str(tmp_path), "job", "run1", 17)
    assert path.endswith("/job_run1_17.log")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 3 and lines[0].endswith(" | hello")
    parsed = audit.parse_lines(spark.read.text(path), "value").collect()
    assert [r.message for r in parsed] == ["hello", "embed: failed = 2", "log only"]


def test_run_report_by_hand(spark):
    def line(h, m, s, text):
        return ("log", f"2025-11-02 {h:02d}:{m:02d}:{s:02d} | {text}")

    rows = [
        line(9, 59, 0, "STEP 1 too early"),
        line(10, 0, 0, "RUN START"), line(10, 0, 0, "STEP 1 a"), line(10, 0, 7, "STEP 1 b"),
        line(10, 0, 8, "STEP 2 a"), line(12, 30, 0, "STEP 2 b"),
        line(12, 31, 0, "RUN START"), line(12, 31, 5, "STEP 1 a"),
        ("log", "no audit line"),
    ]
    lines = spark.createDataFrame(rows, "log string, line string")
    report = audit.run_report(lines, "^RUN START", r"^STEP (\d)").collect()
    got = {(r.run, r.stage): (r.n_lines, r.seconds, r.started) for r in report}
    assert got == {
        (1, "1"): (2, 7, dt.datetime(2025, 11, 2, 10, 0, 0)),
        (1, "2"): (2, 8992, dt.datetime(2025, 11, 2, 10, 0, 8)),
        (2, "1"): (1, 0, dt.datetime(2025, 11, 2, 12, 31, 5)),
    }
