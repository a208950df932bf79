import datetime as dt

from pyspark.sql import functions as F

from riskweave.plans import marts
from riskweave.sources import files, sinks
from riskweave.streaming import jobs as J


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_keeps_created_at(spark):
    old = spark.createDataFrame([("1", "a", 1, 1), ("2", "b", 1, 1)], "cik string, name string, created int, updated int")
    new = spark.createDataFrame([("2", "B", 2, 2), ("3", "c", 2, 2)], "cik string, name string, created int, updated int")
    assert rows(sinks.upsert(old, new, ["cik"], keep=["created"]), "cik", "name", "created", "updated") == [("1", "a", 1, 1), ("2", "B", 1, 2), ("3", "c", 2, 2)]


def test_upsert_of_named_columns_only(spark):
    old = spark.createDataFrame([("1", "a", 1.0, None)], "id string, label string, value double, note string")
    new = spark.createDataFrame([("1", "z", None, "n")], "id string, label string, value double, note string")
    assert rows(sinks.upsert(old, new, ["id"], update=["value"]), "id", "label", "value", "note") == [("1", "a", None, None)]


def test_insert_ignore(spark):
    old = spark.createDataFrame([("1", "a")], "id string, v string")
    new = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    assert rows(sinks.insert_ignore(old, new, ["id"]), "id", "v") == [("1", "a"), ("2", "y")]


def test_replaced_table(spark, tmp_path):
    sinks.replace_table(spark.range(9), str(tmp_path / "t"))
    assert sorted(r["id"] for r in sinks.replace_table(spark.range(2), str(tmp_path / "t")).collect()) == [0, 1]


def test_batches_merge_and_a_replay_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, v int, made int"
    state = lambda: {r["id"]: (r["v"], r["made"]) for r in sinks.current_rows(spark, path, schema, ["id"], keep=["made"], order=["v"]).collect()}
    assert state() == {}
    first = spark.range(20).selectExpr("id", "0 AS v", "1 AS made")
    second = spark.createDataFrame([(7, 5, 9), (7, 4, 8), (90, 6, 9)], schema)
    for batch, number in ((first, 0), (second, 1), (first, 0), (second, 1)):
        sinks.write_batch(batch, path, number)
        if number:
            got = state()
            assert len(got) == 21 and got[7] == (5, 1) and got[90] == (6, 9) and got[8] == (0, 1)
    sinks.write_batch(second.limit(0), path, 2)
    assert len(state()) == 21


def test_compacted_table_reads_its_base_and_later_batches(spark, tmp_path):
    path, schema, rules = str(tmp_path / "t"), "id long, v int, made int", dict(keys=["id"], keep=["made"], order=["v"])
    state = lambda: sorted(map(tuple, sinks.current_rows(spark, path, schema, **rules).collect()))
    assert sinks.compact(spark, path, schema, **rules) is None and state() == []
    batches = [[(i, 0, 1) for i in range(5)], [(1, 5, 9), (1, 4, 8), (7, 1, 1)], [(1, 2, 7), (2, 3, 7)], []]
    sinks.write_batch(spark.createDataFrame(batches[0], schema), path, 0)
    sinks.write_batch(spark.createDataFrame(batches[1], schema), path, 1)
    before = state()
    assert sinks.compact(spark, path, schema, **rules) == 1 and sinks.compact(spark, path, schema, **rules) is None
    assert state() == before == [(0, 0, 1), (1, 5, 1), (2, 0, 1), (3, 0, 1), (4, 0, 1), (7, 1, 1)]
    sinks.write_batch(spark.createDataFrame(batches[1], schema), path, 1)  # a replay of a folded batch
    assert state() == before
    sinks.write_batch(spark.createDataFrame(batches[2], schema), path, 2)
    after = [(0, 0, 1), (1, 2, 1), (2, 3, 1), (3, 0, 1), (4, 0, 1), (7, 1, 1)]
    assert state() == after
    assert sinks.compact(spark, path, schema, **rules) == 2 and state() == after
    plan = sinks.current_rows(spark, path, schema, **rules)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan  # folded batches are not read


def test_staged_filings_and_facts(spark):
    filings = spark.createDataFrame([(" 0001-23-4", "7", " 10-k/a ", "2024-02-10", "2023-12-31"), (None, None, None, None, None)], "accession_number string, cik string, form_type string, filing_date string, period_of_report string")
    got = marts.staged_filings(filings).select("accession_key", "cik", "form", "is_amendment", "days_to_file").collect()
    assert tuple(got[0]) == ("0001234", "0000000007", "10-K", True, 41)
    facts = spark.createDataFrame([("7", "a-1", "us-gaap", "NetIncomeLoss", "10-q", "USD", 1.0, None, None)], "cik string, accession_number string, taxonomy string, concept string, form string, unit string, value double, period_end date, filed date")
    row = marts.staged_facts(facts).first()
    assert (row["tag"], row["concept_label"], row["form"], row["accession_key"]) == ("us-gaap:NetIncomeLoss", "Net Income Loss", "10-Q", "a1")


def test_run_ledger(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    ev = spark.createDataFrame([("r", t(1), "running", 1), ("r", t(2), "completed", 2), ("s", t(3), "running", 3)], "id string, at timestamp, status string, seq int")
    assert rows(sinks.run_states(ev), "id", "status", "n_events") == [("r", "completed", 2), ("s", "running", 1)]
    assert sinks.last_runs(sinks.run_states(ev), 1).first()["id"] == "s"


def test_run_goes_from_running_to_failed(spark):
    start, end = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)
    out = sinks.upsert_table("ingestion_runs", sinks.run_row(spark, "r", start), sinks.run_row(spark, "r", end, "failed", 3, 2, 1, "no file"))
    row = out.first()
    assert (row["started_at"], row["completed_at"], row["status"], row["companies_processed"], row["error_message"]) == (start, end, "failed", 3, "no file")


def test_companies_csv_variants(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Symbol,Security,GICS Sector,CIK\nAAA,Acme,Energy,320193\nBBB,Beta,Odd,\n")
    got = rows(files.companies_csv(spark, str(tmp_path / "a.csv")), "ticker", "name", "cik", "sic_code")
    assert got == [("AAA", "Acme", "0000320193", "1311"), ("BBB", "Beta", "0000000000", "9999")]
    (tmp_path / "b.csv").write_text("symbol\nAAPL\n")
    row = files.companies_csv(spark, str(tmp_path / "b.csv")).first()
    assert row["name"] == "Unknown" and len(row["cik"]) == 10 and 1_000_000 <= int(row["cik"]) < 10_000_000


def write_events(spark, path, name, items):
    df = spark.createDataFrame(items, "audit_id string, generated_at timestamp, event_type string, is_anomaly boolean, final_risk_score double")
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def ev(i, day, hour=0, score=10.0):
    return (f"e{i}", dt.datetime(2024, 1, day, hour), "risk_score_generated", score >= 65, score)


def land(spark, tmp_path):
    import time

    # deliveries in order: repeats of known records, and at last one record far behind the watermark
    lots = [[ev(1, 1), ev(2, 1), ev(3, 2)], [ev(2, 1), ev(4, 12, score=90.0)], [ev(5, 13)], [ev(6, 1), ev(7, 13)]]
    folder = tmp_path / "landed"
    for i, lot in enumerate(lots):
        write_events(spark, str(folder), f"lot={i}", lot)
        time.sleep(1.1)
    schema = spark.read.parquet(str(folder)).drop("lot").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder) + "/*")


def test_stream_drops_repeats(spark, tmp_path):
    stream = land(spark, tmp_path)
    out = str(tmp_path / "out")
    J.run_available(J.deduplicated(stream, "audit_id", "generated_at", "2 days"), "append", str(tmp_path / "cp"), path=out)
    got = [r["audit_id"] for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and {"e1", "e2", "e3", "e4", "e5"} <= set(got)
    # the record that came days after its time is past the watermark
    assert "e6" not in got


def test_stream_windows_merge_and_ignore_late_rows(spark, tmp_path):
    stream = land(spark, tmp_path)
    path = str(tmp_path / "mon")
    J.run_available(J.windowed_monitor(stream, "1 day"), "update", str(tmp_path / "cp2"), each=J.batches_into(path))
    table = sinks.current_rows(spark, path, J.MONITOR, ["window_start"])
    got = {r["window_start"].day: r["total_scored"] for r in table.collect()}
    assert got == {1: 3, 2: 1, 12: 1, 13: 2}
    assert table.where(F.dayofmonth("window_start") == 12).first()["anomaly_rate"] == 1.0


def test_stream_reads_a_table_of_several_files(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "one"))
    for name, n in (("many.parquet", 30), ("one", 7)):
        out = str(tmp_path / f"out-{n}")
        J.run_available(J.file_stream(spark, str(tmp_path), name, 1), "append", str(tmp_path / f"state-{n}"), path=out)
        assert spark.read.parquet(out).count() == n
