import hashlib
import json
import os

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from snapharbor.operators import payloads
from snapharbor.operators import runs as run_ops
from snapharbor.plans import ingestion
from snapharbor.plans.workflow import run_snapshot, stage_snapshot, transform_only
from snapharbor.operators.quality import DataQualityError
from snapharbor.operators.upsert import EmptySnapshotError
from snapharbor.sources import publication, raw as raw_source, tables
from snapharbor.spec import PUBLISHED_RELATIONS
from snapharbor.streaming import ingest

FIELDS = ["id", "b", "a"]


def pages(spark):
    rows = [("d", 0, 1, "x", "2", None), ("d", 0, 0, "w", "é", "1"), ("d", 1, 0, "y", None, 'q"t')]
    return spark.createDataFrame(rows, "dataset string, page long, pos int, id string, b string, a string")


def test_payload_is_canonical(spark):
    got = payloads.page_digest(pages(spark), ["dataset", "page"], "pos", FIELDS)
    first = got.where("page = 0").first()
    want = json.dumps(
        [{"a": "1", "b": "é", "id": "w"}, {"b": "2", "id": "x"}],
        ensure_ascii=False, sort_keys=True, separators=(",", ":"),
    )
    assert first["payload"] == want and first["row_count"] == 2
    assert first["payload_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_detail_pages_split_a_hot_batch(spark):
    rows = spark.range(105).select(
        F.when(F.col("id") < 100, 0).otherwise(1).alias("batch"), F.lit("same").alias("k"), "id"
    )
    cut = payloads.detail_pages(rows, "batch", ["k"], 10)
    sizes = cut.groupBy("batch", "chunk").count()
    assert values(sizes) == [(0, i, 10) for i in range(10)] + [(1, 0, 5)]
    assert cut.select("id").distinct().count() == 105


def test_ledger_flags_repeats(spark):
    frame = "dataset string, payload_sha256 string, raw_path string, n int"
    ledger = spark.createDataFrame([("v", "old", "p", 0)], frame)
    incoming = spark.createDataFrame(
        [("v", "old", "p1", 1), ("v", "new", "p2", 2), ("v", "new", "p3", 3), ("f", "old", "p4", 4)], frame
    )
    after, flagged = payloads.ledger_insert(ledger, incoming, ["n"])
    assert values(flagged, "raw_path", "duplicate") == [
        ("p1", True), ("p2", False), ("p3", True), ("p4", False)
    ]
    assert values(after, "dataset", "payload_sha256", "raw_path") == [
        ("f", "old", "p4"), ("v", "new", "p2"), ("v", "old", "p")
    ]
    again, flags = payloads.ledger_insert(after, incoming, ["n"])
    assert again.count() == 3
    assert values(payloads.duplicate_payload_count(flags, "dataset")) == [("f", 1), ("v", 3)]


def test_landed_pages_are_checked(spark, tmp_path):
    root = str(tmp_path / "raw")
    digests = payloads.page_digest(pages(spark), ["dataset", "page"], "pos", FIELDS)
    digests = digests.withColumn("chunk", F.lit(0)).cache()
    raw_source.land_raw_pages(digests, root, "run-1")
    rows = raw_source.scan_pages(spark, root, "run-1", "d", FIELDS)
    assert values(rows, "pos", *FIELDS) == [(0, "w", "é", "1"), (0, "y", None, 'q"t'), (1, "x", "2", None)]
    assert raw_source.raw_integrity_scan(spark, root).where("not ok").count() == 0
    # any byte of a payload, the last one too
    other = str(tmp_path / "damaged")
    last = F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit("}"))
    body = F.when(F.col("page") == 0, last).otherwise(F.col("payload"))
    raw_source.land_raw_pages(digests.withColumn("payload", body), other, "run-1")
    scan = raw_source.raw_integrity_scan(spark, other)
    assert scan.where("not ok").count() == 1
    wanted = digests.select("payload_sha256").unionByName(
        spark.createDataFrame([("absent",)], "payload_sha256 string")
    )
    assert raw_source.missing_pages(scan, wanted).count() == 2


def test_payloads_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "raw")
    digests = payloads.page_digest(pages(spark), ["dataset", "page"], "pos", FIELDS)
    digests = digests.withColumn("chunk", F.lit(0)).cache()
    raw_source.land_raw_pages(digests.where("page = 0"), root, "run-1")
    raw_source.land_raw_pages(digests, root, "run-2")
    assert values(raw_source.payload_ledger(spark, root), "stored_in") == [("run-1",), ("run-2",)]
    second = raw_source.read_manifest(spark, root, "run-2")
    assert values(second, "page", "stored_in", "duplicate") == [(0, "run-1", True), (1, "run-2", False)]
    assert raw_source.scan_pages(spark, root, "run-2", "d", FIELDS).count() == 3
    assert raw_source.scan_pages(spark, root, "run-1", "d", FIELDS).count() == 2


@pytest.mark.parametrize("body", ['{"id": "a"}', "[1, 2]", "nonsense", '[{"id": "a"}, null]', "[null]"])
def test_pages_must_be_arrays_of_objects(spark, tmp_path, body):
    (tmp_path / "page.json").write_text(body)
    with pytest.raises(Exception, match="array of objects|MALFORMED"):
        raw_source.scan_raw_json(spark, str(tmp_path), ["id"]).collect()


def test_empty_page_is_allowed(spark, tmp_path):
    (tmp_path / "page.json").write_text(" [ ] \n")
    assert raw_source.scan_raw_json(spark, str(tmp_path), ["id"]).collect() == []


def test_raw_nulls_and_absent_keys_read_as_null(spark, tmp_path):
    (tmp_path / "page.json").write_text('[{"id": "a", "b": null}, {"id": "c", "z": 1}]')
    got = raw_source.scan_raw_json(spark, str(tmp_path), ["id", "b"])
    assert values(got, "id", "b") == [("a", None), ("c", None)]


# --- publication -----------------------------------------------------------------


def small(spark, n):
    return {r: spark.range(n).withColumnRenamed("id", r) for r in PUBLISHED_RELATIONS}


def test_publish_replaces_the_whole_set(spark, tmp_path):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)
    publication.publish_set(small(spark, 2), root)
    third = publication.publish_set(small(spark, 3), root)
    assert len(third) == 8
    for relation in PUBLISHED_RELATIONS:
        assert publication.scan_published(spark, root, relation).count() == 3
    # the current set and the one before stay
    assert len([n for n in os.listdir(root) if n.startswith("set-")]) == 2


def test_failed_publication_keeps_the_old_set(spark, tmp_path):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)
    broken = small(spark, 2)
    broken["mart_ev_metrics"] = spark.range(2).select(F.raise_error(F.lit("disk full")))
    with pytest.raises(Exception, match="disk full"):
        publication.publish_set(broken, root)
    assert publication.scan_published(spark, root, "dim_vehicle").count() == 1
    assert len([n for n in os.listdir(root) if n.startswith("set-")]) == 1


def test_failed_commit_keeps_the_old_set(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)

    def fail(*_):
        raise OSError("no commit")

    monkeypatch.setattr(publication, "_commit", fail)
    with pytest.raises(OSError):
        publication.publish_set(small(spark, 2), root)
    assert publication.scan_published(spark, root, "dim_vehicle").count() == 1


def test_incomplete_set_is_refused(spark, tmp_path):
    part = small(spark, 1)
    del part["dim_vehicle"]
    with pytest.raises(publication.IncompletePublicationError, match="dim_vehicle"):
        publication.publish_set(part, str(tmp_path / "pub"))
    with pytest.raises(ValueError, match="dim_vehicle"):
        tables.output_inventory(part, PUBLISHED_RELATIONS)
    with pytest.raises(FileNotFoundError):
        publication.scan_published(spark, str(tmp_path / "pub"), "dim_vehicle")


def test_a_second_writer_keeps_its_set(spark, tmp_path):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)
    # another job has written a set and not yet committed it
    other = "0000000002-other"
    paths = [
        publication.write_zstd_parquet(df, f"{root}/set-{other}", r) for r, df in small(spark, 7).items()
    ]
    publication.publish_set(small(spark, 2), root)
    publication.publish_set(small(spark, 3), root)
    publication._commit(spark, root, other, paths)
    assert all(spark.read.parquet(p).count() == 7 for p in paths)
    # uncommitted sets go when their lease is over, a commit without its folder is refused
    late = "0000000009-late"
    late_paths = [publication.write_zstd_parquet(spark.range(1), f"{root}/set-{late}", "dim_vehicle")]
    newest = publication.current_set(spark, root)
    publication.sweep_published(spark, root, newest, lease_seconds=-1)
    with pytest.raises(publication.IncompletePublicationError):
        publication._commit(spark, root, late, late_paths)
    assert publication.current_set(spark, root) == newest
    assert publication.scan_published(spark, root, "dim_vehicle").count() == 3


def test_a_newer_set_of_another_writer_stays(spark, tmp_path):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)
    newer = "0000000008-newer"
    paths = [
        publication.write_zstd_parquet(df, f"{root}/set-{newer}", r) for r, df in small(spark, 7).items()
    ]
    publication._commit(spark, root, newer, paths)
    publication.sweep_published(spark, root, "0000000002-mine")
    assert publication.scan_published(spark, root, "dim_vehicle").count() == 7


def test_clear_published(spark, tmp_path):
    root = str(tmp_path / "pub")
    publication.publish_set(small(spark, 1), root)
    publication.clear_published(spark, root)
    assert publication.current_set(spark, root) is None


# --- whole runs ------------------------------------------------------------------


def test_snapshot_run_publishes_checked_models(spark, raw, runs, spec, tmp_path):
    vehicles, fuels = raw
    anchors = fuels.select(spec.raw_id).distinct()
    root = str(tmp_path / "pub")
    staged = stage_snapshot(anchors, vehicles, fuels, spec, "run-1")
    result = run_snapshot(spark, staged, runs, root, spec)
    assert result.relation_rows["mart_ev_overview"] == 6
    assert result.relation_rows["fact_vehicle_fuel"] == 10
    assert set(result.quality_checks.values()) == {0}
    smaller = stage_snapshot(anchors, vehicles, fuels, spec, "run-1", limit=2)
    assert run_snapshot(spark, smaller, runs, root, spec).relation_rows["mart_ev_overview"] == 2
    assert publication.scan_published(spark, root, "dim_vehicle").count() == 2


def test_failing_model_test_blocks_publication(spark, staging, spec, tmp_path):
    """A vehicle without an electric or hydrogen fuel breaks the row-count test."""
    root = str(tmp_path / "pub")
    plain = staging["fuels"].withColumn(
        "fuel_type",
        F.when(F.col("fuel_type") == "Elektriciteit", "Benzine").otherwise(F.col("fuel_type")),
    )
    with pytest.raises(DataQualityError, match="fact_snapshot_rowcount"):
        transform_only(spark, {**staging, "fuels": plain}, root, spec)
    assert publication.current_set(spark, root) is None
    assert os.listdir(root) == [] if os.path.isdir(root) else True


def test_transform_rejects_bad_staging(spark, staging, spec, tmp_path):
    root = str(tmp_path / "pub")
    bad = {**staging, "vehicles": staging["vehicles"].drop("brand")}
    with pytest.raises(DataQualityError, match="missing staging.vehicles.brand"):
        transform_only(spark, bad, root, spec)
    doubled = {**staging, "vehicles": staging["vehicles"].unionByName(staging["vehicles"])}
    with pytest.raises(DataQualityError, match="duplicate_vehicles': 6"):
        transform_only(spark, doubled, root, spec)
    empty = {**staging, "vehicles": staging["vehicles"].where("false")}
    with pytest.raises(EmptySnapshotError):
        transform_only(spark, empty, root, spec)
    assert publication.current_set(spark, root) is None


# --- runs ------------------------------------------------------------------------


def test_run_metrics_and_evolution(spark, runs):
    row = run_ops.run_metrics(runs.withColumn("completed_at", F.col("started_at"))).first()
    assert row["processed_rows"] == 10 and row["processed_rows_per_second"] == 0.0
    assert runs.first()["ingestion_mode"] == "legacy_sample" and runs.first()["requested_limit"] == 6
    old = runs.drop("active_duration_seconds").withColumn("run_duration_seconds", F.lit(4.0))
    assert run_ops.evolve_runs(old).first()["active_duration_seconds"] == 4.0
    new = run_ops.evolve_runs(runs.withColumn("checkpoint_status", F.lit("completed")).withColumn("ingestion_mode", F.lit("resumable_snapshot")))
    assert new.first()["ingestion_mode"] == "resumable_snapshot"


def test_run_upsert_keeps_ids_unique(spark, runs):
    done = runs.withColumn("status", F.lit("succeeded")).withColumn("sequence", F.lit(2))
    running = runs.withColumn("status", F.lit("running")).withColumn("sequence", F.lit(1))
    other = running.withColumn("ingestion_id", F.lit("run-2"))
    for changed in ((done, running, other), (other, running, done)):
        got = run_ops.run_upsert(runs, changed[0].unionByName(changed[1]).unionByName(changed[2]))
        assert values(got, "ingestion_id", "status") == [("run-1", "succeeded"), ("run-2", "running")]


# --- streaming -------------------------------------------------------------------


def page_payloads(raw, spec):
    vehicles, fuels = raw
    anchors = fuels.select(spec.raw_id).distinct()
    return ingestion.cut_pages(anchors, vehicles, fuels, spec, 3).cache()


def ingested(spark, root, log, spec, run):
    ingest.stream_page_ingest(spark, root, log, spec, run).awaitTermination()
    return {n: values(df) for n, df in ingest.settle(spark, log).items()}


def test_stream_resumes_and_replays(spark, raw, spec, staging, tmp_path):
    root, log = str(tmp_path / "raw"), str(tmp_path / "log")
    all_pages = page_payloads(raw, spec)
    raw_source.land_raw_pages(all_pages.where("page = 0"), root, "run-1", pages_per_file=1)
    first = ingested(spark, root, log, spec, "run-1")
    assert len(first["vehicles"]) == 3
    raw_source.land_raw_pages(all_pages.where("page = 1"), root, "run-1", pages_per_file=2)
    done = ingested(spark, root, log, spec, "run-1")
    assert done["vehicles"] == values(staging["vehicles"])
    assert done["fuels"] == values(staging["fuels"])
    assert ingested(spark, root, log, spec, "run-1") == done
    # A crash between the write and the commit replays the last batch.
    commits = tmp_path / "log" / "_checkpoint" / "commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(commits / name)
    assert ingested(spark, root, log, spec, "run-1") == done
    text = "".join(str(r) for rows in done.values() for r in rows)
    assert "HYB-P" not in text


def test_a_smaller_snapshot_removes_old_rows(spark, raw, spec, tmp_path):
    root = str(tmp_path / "raw")
    raw_source.land_raw_pages(page_payloads(raw, spec), root, "run-0")
    assert len(ingested(spark, root, str(tmp_path / "log0"), spec, "run-0")["vehicles"]) == 6
    vehicles, fuels = raw
    changed = vehicles.withColumn("merk", F.lit("new")), fuels
    smaller = page_payloads([df.where(F.col(spec.raw_id).isin("BAT", "HYD")) for df in changed], spec)
    raw_source.land_raw_pages(smaller, root, "run-1")
    after = ingested(spark, root, str(tmp_path / "log1"), spec, "run-1")
    assert len(after["vehicles"]) == 2 and all("NEW" in r for r in after["vehicles"])


def test_an_identical_rerun_gives_the_same_rows(spark, raw, spec, tmp_path):
    root, all_pages = str(tmp_path / "raw"), page_payloads(raw, spec)
    got = []
    for run in ("run-1", "run-2"):
        raw_source.land_raw_pages(all_pages, root, run)
        settled = ingested(spark, root, str(tmp_path / run), spec, run)
        got.append({n: [tuple(v for v in r if v != run) for r in rows] for n, rows in settled.items()})
    assert got[0] == got[1]
    assert raw_source.read_manifest(spark, root, "run-2").where("not duplicate").count() == 0


def test_a_page_that_arrives_again_counts_once(spark, raw, spec, tmp_path):
    """The same page landed twice, the second time with other content."""
    root, all_pages = str(tmp_path / "raw"), page_payloads(raw, spec)
    raw_source.land_raw_pages(all_pages, root, "run-1")
    raw_source.land_raw_pages(all_pages.where("page = 0"), root, "run-1", arrival=1)
    vehicles, fuels = raw
    other = page_payloads((vehicles.withColumn("merk", F.lit("later")), fuels), spec)
    raw_source.land_raw_pages(other.where("page = 1"), root, "run-1", arrival=2)
    got = ingested(spark, root, str(tmp_path / "log"), spec, "run-1")
    assert len(got["vehicles"]) == 6 and len(got["fuels"]) == 10
    assert sum("LATER" in r for r in got["vehicles"]) == 3


def test_incomplete_vehicles_are_not_settled(spark, raw, spec, tmp_path):
    vehicles, fuels = raw
    root = str(tmp_path / "raw")
    parts = page_payloads(raw, spec).where("dataset <> 'vehicles'").unionByName(
        page_payloads((vehicles.where(F.col(spec.raw_id) != "BAT"), fuels), spec).where("dataset = 'vehicles'")
    )
    raw_source.land_raw_pages(parts, root, "run-1")
    got = ingested(spark, root, str(tmp_path / "log"), spec, "run-1")
    assert len(got["vehicles"]) == 5 and len(got["fuels"]) == 9


def test_a_failed_job_resumes(spark, raw, spec, tmp_path, monkeypatch):
    root, folders = str(tmp_path / "warehouse"), ingestion.Folders(str(tmp_path / "warehouse"))
    all_pages = page_payloads(raw, spec)
    real = ingestion.transform_only
    monkeypatch.setattr(ingestion, "transform_only", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingestion.snapshot_job(spark, all_pages, root, spec, "run-1")
    row = ingestion.read_runs(spark, folders).first()
    assert row["status"] == "transformation_failed" and row["checkpoint_status"] == "transformation_failed"
    assert row["error_message"] == "lost" and row["resume_count"] == 0
    assert publication.current_set(spark, folders.published) is None
    monkeypatch.setattr(ingestion, "transform_only", real)
    # all pages are staged: none is needed again
    result = ingestion.snapshot_job(spark, None, root, spec, "run-1")
    row = ingestion.read_runs(spark, folders).first()
    assert row["status"] == "succeeded" and row["resumed"] and row["resume_count"] == 1
    assert row["error_message"] is None and row["matched_vehicles"] == 6 and row["fuel_rows"] == 10
    assert row["duplicate_payloads"] == 0 and result.relation_rows["mart_ev_overview"] == 6
    # a second, smaller run replaces the snapshot; the first run's row stays
    vehicles, fuels = raw
    fewer = [df.where(F.col(spec.raw_id).isin("BAT", "HYD")) for df in (vehicles, fuels)]
    result = ingestion.snapshot_job(spark, page_payloads(fewer, spec), root, spec, "run-2")
    assert result.relation_rows["mart_ev_overview"] == 2
    assert values(ingestion.read_runs(spark, folders), "ingestion_id", "status") == [
        ("run-1", "succeeded"), ("run-2", "succeeded")
    ]


def test_damaged_storage_stops_the_job(spark, raw, spec, tmp_path):
    root = str(tmp_path / "warehouse")
    broken = page_payloads(raw, spec).withColumn("payload_sha256", F.concat(F.lit("x"), "payload_sha256"))
    with pytest.raises(DataQualityError, match="lost or damaged"):
        ingestion.snapshot_job(spark, broken, root, spec, "run-1")


def test_anchor_pages_out_of_order_stop_the_job(spark, raw, spec, tmp_path):
    root, folders = str(tmp_path / "warehouse"), ingestion.Folders(str(tmp_path / "warehouse"))
    good = page_payloads(raw, spec)
    ingestion.snapshot_job(spark, good, root, spec, "run-1")
    before = publication.current_set(spark, folders.published)
    swapped = good.withColumn("page", F.when(F.col("dataset") == "anchors", 1 - F.col("page")).otherwise(F.col("page")))
    first = good.where("dataset = 'anchors' and page = 0")
    repeated = good.unionByName(first.withColumn("page", F.col("page") + 2))
    for run, broken in (("run-2", swapped), ("run-3", repeated)):
        with pytest.raises(DataQualityError, match="out of order"):
            ingestion.snapshot_job(spark, broken, root, spec, run)
        row = ingestion.read_runs(spark, folders).where(F.col("ingestion_id") == run).first()
        assert row["status"] == "failed" and "out of order" in row["error_message"]
        assert publication.current_set(spark, folders.published) == before


def test_entry_matches_the_known_mix(spark):
    import __spark_entry__ as entry

    assert values(entry.entry(spark)) == [
        ("Battery electric", 105), ("Hybrid electric", 242), ("Hydrogen electric", 1028)
    ]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_events_stream_reads_every_row(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    out = str(tmp_path / "events")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{SF}/events.parquet").count()
