"""Broken-off jobs, several writers, and what a micro-batch reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import threading
from dataclasses import replace

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor.operators.quality import DataQualityError
from snapharbor.operators.upsert import EmptySnapshotError
from snapharbor.plans import ingestion
from snapharbor.sources import publication, raw as raw_source
from snapharbor.streaming import ingest


@pytest.fixture(scope="module")
def all_pages(spark, raw, spec):
    vehicles, fuels = raw
    return ingestion.cut_pages(fuels.select(spec.raw_id).distinct(), vehicles, fuels, spec, 2).cache()


def run_row(spark, root, run="run-1"):
    return ingestion.read_runs(spark, ingestion.Folders(root)).where(F.col("ingestion_id") == run).first()


def killed(*_args, **_kwargs):
    raise KeyboardInterrupt("the driver is gone")


# --- windows in which a job may die ----------------------------------------------

WINDOWS = {
    # name: (what the driver dies in, status it leaves, whether pages are needed again)
    "land_raw_pages": ("running", True),
    "settle": ("running", True),
    "stage_run": ("running", True),
    "transform_only": ("transforming", False),
}


@pytest.mark.parametrize("window", list(WINDOWS))
def test_a_driver_that_dies_leaves_a_run_that_goes_on(spark, all_pages, spec, tmp_path, monkeypatch, window):
    root, folders = str(tmp_path), ingestion.Folders(str(tmp_path))
    status, again = WINDOWS[window]
    with monkeypatch.context() as patch:
        patch.setattr(ingestion, window, killed)
        with pytest.raises(KeyboardInterrupt):
            ingestion.snapshot_job(spark, all_pages, root, spec, "run-1")
    assert run_row(spark, root)["status"] == status
    assert publication.current_set(spark, folders.published) is None
    if again:
        with pytest.raises(ingestion.ResumeError):
            ingestion.snapshot_job(spark, None, root, spec, "run-1")
    result = ingestion.snapshot_job(spark, all_pages if again else None, root, spec, "run-1")
    row = run_row(spark, root)
    assert result.relation_rows["mart_ev_overview"] == 6 and result.relation_rows["fact_vehicle_fuel"] == 10
    assert row["status"] == "succeeded" and row["checkpoint_status"] == "completed" and row["resumed"]
    assert row["matched_vehicles"] == 6 and row["fuel_rows"] == 10 and row["error_message"] is None


def test_a_driver_that_dies_behind_the_publication(spark, all_pages, spec, tmp_path, monkeypatch):
    root, real = str(tmp_path), ingestion.save_run

    def dies(spark, folders, run):
        if run["status"] in ("finalizing", "succeeded"):
            killed()
        return real(spark, folders, run)

    with monkeypatch.context() as patch:
        patch.setattr(ingestion, "save_run", dies)
        with pytest.raises(KeyboardInterrupt):
            ingestion.snapshot_job(spark, all_pages, root, spec, "run-1")
    assert run_row(spark, root)["checkpoint_status"] == "staging_complete"
    result = ingestion.snapshot_job(spark, None, root, spec, "run-1")
    assert result.relation_rows["dim_vehicle"] == 6 and run_row(spark, root)["status"] == "succeeded"


def test_a_run_that_succeeded_is_not_run_again(spark, all_pages, spec, tmp_path, monkeypatch):
    root, folders = str(tmp_path), ingestion.Folders(str(tmp_path))
    first = ingestion.snapshot_job(spark, all_pages, root, spec, "run-1")
    published = publication.current_set(spark, folders.published)
    monkeypatch.setattr(ingestion, "land_raw_pages", killed)
    assert ingestion.snapshot_job(spark, all_pages, root, spec, "run-1") == first
    assert publication.current_set(spark, folders.published) == published
    assert run_row(spark, root)["resume_count"] == 0
    os.remove(folders.result("run-1"))
    assert ingestion.snapshot_job(spark, None, root, spec, "run-1").relation_rows == first.relation_rows


def test_another_run_was_staged_before_the_resume(spark, raw, all_pages, spec, tmp_path, monkeypatch):
    root = str(tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(ingestion, "transform_only", killed)
        with pytest.raises(KeyboardInterrupt):
            ingestion.snapshot_job(spark, all_pages, root, spec, "run-1")
    vehicles, fuels = (df.where(F.col(spec.raw_id).isin("BAT", "HYD")) for df in raw)
    fewer = ingestion.cut_pages(fuels.select(spec.raw_id).distinct(), vehicles, fuels, spec, 2)
    assert ingestion.snapshot_job(spark, fewer, root, spec, "run-2").relation_rows["dim_vehicle"] == 2
    assert ingestion.snapshot_job(spark, None, root, spec, "run-1").relation_rows["dim_vehicle"] == 6
    # whatever is staged can be transformed again; runs stay as they are
    before = values(ingestion.read_runs(spark, ingestion.Folders(root)))
    assert ingestion.transform_staged(spark, root, spec).relation_rows["dim_vehicle"] == 6
    assert values(ingestion.read_runs(spark, ingestion.Folders(root))) == before


@pytest.mark.parametrize("change", [{"limit": 3}, {"page_size": 5}, {"spec": "other"}])
def test_a_run_keeps_its_settings(spark, all_pages, spec, tmp_path, change):
    root = str(tmp_path)
    broken = all_pages.withColumn("payload_sha256", F.concat(F.lit("x"), "payload_sha256"))
    with pytest.raises(DataQualityError):
        ingestion.snapshot_job(spark, broken, root, spec, "run-1", page_size=2)
    other = replace(spec, salt="another") if "spec" in change else spec
    settings = {"page_size": 2} | {k: v for k, v in change.items() if k != "spec"}
    with pytest.raises(ingestion.ResumeError, match="differs"):
        ingestion.snapshot_job(spark, all_pages, root, other, "run-1", **settings)
    assert run_row(spark, root)["status"] == "failed"


def test_limit_takes_the_first_complete_vehicles(spark, raw, spec, tmp_path):
    """In the order of the anchor pages; the second id has no vehicle row and uses up nothing."""
    vehicles, fuels = raw
    ids = sorted(r[0] for r in fuels.select(spec.raw_id).distinct().collect())
    vehicles = vehicles.where(F.col(spec.raw_id) != ids[1])
    pages = ingestion.cut_pages(fuels.select(spec.raw_id).distinct(), vehicles, fuels, spec, 2)
    root = str(tmp_path)
    result = ingestion.snapshot_job(spark, pages, root, spec, "run-1", limit=3)
    row = run_row(spark, root)
    assert result.relation_rows["dim_vehicle"] == 3
    assert row["requested_limit"] == 3 and row["matched_vehicles"] == 3 and row["rejected_rows"] == 1
    staged = publication.scan_published(spark, ingestion.Folders(root).staging, "vehicles")
    from snapharbor.functions.keys import salted_sha256

    kept = spark.createDataFrame([(i,) for i in (ids[0], ids[2], ids[3])], "id string")
    hashed = kept.select(salted_sha256(F.col("id"), spec.salt).alias("h"))
    assert values(staged, "vehicle_id_hash") == values(hashed, "h")


def test_cursor_of_a_broken_off_run(spark, all_pages, spec, tmp_path):
    root, folders = str(tmp_path), ingestion.Folders(str(tmp_path))
    assert ingestion.run_cursor(spark, root, spec, "run-1") is None
    raw_source.land_raw_pages(all_pages.where("page < 2"), folders.raw, "run-1")
    ids = sorted(
        r["id"]
        for r in ingestion.anchor_pages(spark, folders, spec, "run-1").select(F.col(spec.raw_id).alias("id")).collect()
    )
    assert ingestion.run_cursor(spark, root, spec, "run-1") == ids[-1] and len(ids) == 4
    # the second page arrives damaged: the run goes on behind the first one
    bad = all_pages.where("page = 1 and dataset = 'anchors'").withColumn("payload", F.lit('[{"kenteken":"?"}]'))
    bad = bad.withColumn("payload_sha256", F.lit("0" * 64))
    raw_source.land_raw_pages(bad, folders.raw, "run-1", arrival=1)
    assert ingestion.run_cursor(spark, root, spec, "run-1") == ids[1]


def test_a_run_without_complete_vehicles_fails(spark, all_pages, spec, tmp_path):
    with pytest.raises(EmptySnapshotError):
        ingestion.snapshot_job(spark, all_pages.where("dataset <> 'fuels'"), str(tmp_path), spec, "run-1")
    assert run_row(spark, str(tmp_path))["status"] == "failed"


# --- checking storage ------------------------------------------------------------


def test_only_new_blocks_are_checked(spark, all_pages, spec, tmp_path, monkeypatch):
    root = str(tmp_path)
    raw_source.land_raw_pages(all_pages.where("page < 2"), root, "run-1", pages_per_file=3)
    assert raw_source.verify_run(spark, root, "run-1").count() == 0
    raw_source.land_raw_pages(all_pages, root, "run-2", pages_per_file=3)
    opened = []
    real = raw_source.block_payloads
    monkeypatch.setattr(raw_source, "block_payloads", lambda s, r, places: (opened.extend(places), real(s, r, places))[1])
    assert raw_source.verify_run(spark, root, "run-2").count() == 0
    assert {run for run, _ in opened} == {"run-2"}
    opened.clear()
    assert raw_source.verify_run(spark, root, "run-2").count() == 0 and opened == []


def test_damage_in_an_unchecked_old_run_is_found(spark, all_pages, tmp_path):
    root = str(tmp_path)
    damaged = F.when(F.col("page") == 0, F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    raw_source.land_raw_pages(all_pages.withColumn("payload", damaged), root, "run-1", pages_per_file=3)
    raw_source.land_raw_pages(all_pages, root, "run-2", pages_per_file=3)
    lost = raw_source.verify_run(spark, root, "run-2")
    want = all_pages.where("page = 0").select("payload_sha256").distinct()
    assert values(lost) == values(want)
    # a block with a fault is looked at again
    assert values(raw_source.verify_run(spark, root, "run-2")) == values(want)


# --- the stream ------------------------------------------------------------------


def test_blocks_hold_whole_pages(spark, all_pages, tmp_path):
    root = str(tmp_path)
    raw_source.land_raw_pages(all_pages, root, "run-1", pages_per_file=4)
    named = raw_source.read_manifest(spark, root, "run-1")
    assert named.groupBy("page").agg(F.countDistinct("slot").alias("n")).where("n > 1").count() == 0
    assert named.select("slot").distinct().count() > 1
    assert named.join(all_pages, ["dataset", "page", "chunk", "payload_sha256"]).count() == all_pages.count()
    for r in named.select("slot").distinct().collect():
        files = [n for n in os.listdir(f"{root}/manifest/run=run-1/slot={r['slot']}") if n.endswith(".parquet")]
        assert len(files) == 1


@pytest.mark.parametrize("pages_per_file,blocks_per_batch", [(1, 1), (4, 2), (1000, 1)])
def test_counters_of_the_batches_equal_those_of_the_log(spark, raw, spec, tmp_path, pages_per_file, blocks_per_batch):
    vehicles, fuels = raw
    ids = fuels.select(spec.raw_id).distinct().unionByName(
        spark.createDataFrame([("  ",), ("NOBODY",)], f"{spec.raw_id} string")
    )
    pages = ingestion.cut_pages(ids, vehicles.where(F.col(spec.raw_id) != "BAT"), fuels, spec, 2).cache()
    root, log = str(tmp_path / "raw"), str(tmp_path / "log")
    raw_source.land_raw_pages(pages, root, "run-1", pages_per_file=pages_per_file)

    def stream():
        ingest.stream_page_ingest(spark, root, log, spec, "run-1", blocks_per_batch).awaitTermination()
        counted = values(ingest.counted_pages(spark, log), "page", *ingest.COUNTED)
        assert counted == values(ingest.settled_counters(spark, log), "page", *ingest.COUNTED)
        return counted

    first = stream()
    totals = ingest.batch_totals(spark, log).agg(*[F.sum(c).alias(c) for c in ("pages", *ingest.COUNTED)]).first()
    assert totals["pages"] == len(first)
    assert [totals[c] for c in ingest.COUNTED] == [sum(r[k] for r in first) for k in range(1, 5)]
    assert sum(r[4] for r in first) == 3  # the blank id, the unknown one, the one without vehicle row
    # a crash between the write and the commit replays the last batch
    commits = tmp_path / "log" / "_checkpoint" / "commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(commits / name)
    assert stream() == first
    # a page that arrives again is counted once
    raw_source.land_raw_pages(pages.where("page = 0"), root, "run-1", arrival=1)
    assert stream() == first


SCRIPT = """
import json, sys
sys.path.insert(0, sys.argv[1]); sys.path.insert(0, sys.argv[1] + "/tests")
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
folder = sys.argv[2]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + folder + "/events")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", folder + "/scratch").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from dataclasses import replace
from snapharbor.plans import ingestion
from snapharbor.session import configure
from snapharbor.sources import raw
from snapharbor.spec import VEHICLE_SPEC
from snapharbor.streaming import ingest
configure(spark)
spec = replace(VEHICLE_SPEC, salt="test-salt")
ids = spark.range(400).select(F.format_string("ID%05d", "id").alias(spec.raw_id))
def rows(columns, **given):
    return ids.select(*[given.get(c, F.lit(None).cast("string")).alias(c) if c != spec.raw_id else F.col(c) for c in columns])
vehicles = rows(spec.raw_vehicle_columns, merk=F.sha2(spec.raw_id, 512), voertuigsoort=F.sha2(F.reverse(spec.raw_id), 512))
fuels = rows(spec.raw_fuel_columns, brandstof_omschrijving=F.lit("Waterstof"), brandstof_volgnummer=F.lit("1"),
    emissiecode_omschrijving=F.sha2(spec.raw_id, 384))
pages = ingestion.cut_pages(ids, vehicles, fuels, spec, 20).cache()
pages.count()
raw.land_raw_pages(pages, folder + "/raw", "run-1", pages_per_file=3)
spark.sparkContext.setJobGroup("x", "ingest")
jobs = ingest.stream_page_ingest(spark, folder + "/raw", folder + "/log", spec, "run-1", 1)
jobs.awaitTermination()
print(json.dumps({"batches": ingest.batch_totals(spark, folder + "/log").count(), "payloads": pages.count(),
    "staged": ingest.settle(spark, folder + "/log")["vehicles"].count()}))
spark.stop()
"""


def test_batches_read_every_payload_once(tmp_path):
    """From the event log of a run of 20 batches: the payload scans read each stored row once."""
    (tmp_path / "events").mkdir()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo, str(tmp_path)], capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-2000:]
    said = json.loads(done.stdout.strip().splitlines()[-1])
    assert said["batches"] == 20 and said["staged"] == 400
    folder = str(tmp_path / "raw" / "payloads")
    (log,) = (tmp_path / "events").iterdir()
    scans, rows = {}, {}

    def walk(plan):
        if plan["nodeName"].startswith("Scan parquet"):
            place = plan.get("metadata", {}).get("Location", "")
            if folder in place:
                for m in plan["metrics"]:
                    if m["name"] == "number of output rows":
                        scans[m["accumulatorId"]] = plan["metadata"].get("PartitionFilters", "")
        for child in plan["children"]:
            walk(child)

    with open(log) as lines:
        for line in lines:
            event = json.loads(line)
            if "sparkPlanInfo" in event:
                walk(event["sparkPlanInfo"])
            if event["Event"] == "SparkListenerTaskEnd":
                for a in event["Task Info"]["Accumulables"]:
                    if a["ID"] in scans:
                        rows[a["ID"]] = rows.get(a["ID"], 0) + int(a["Update"])
    # landing and the ledger read no payload column; every scan counted here belongs to a batch
    assert sum(rows.values()) == said["payloads"]


# --- several writers -------------------------------------------------------------


def test_two_jobs_save_runs_at_once(spark, tmp_path):
    folders = ingestion.Folders(str(tmp_path))
    errors = []

    def save(name):
        try:
            for status in ("running", "succeeded"):
                ingestion.save_run(spark, folders, {"ingestion_id": name, "status": status})
        except BaseException as error:  # noqa: BLE001
            errors.append(error)

    writers = [threading.Thread(target=save, args=(f"run-{k}",)) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert errors == []
    assert values(ingestion.read_runs(spark, folders), "ingestion_id", "status") == [
        (f"run-{k}", "succeeded") for k in range(4)
    ]


def one(spark, n):
    return {"t": spark.range(n)}


def test_a_set_computed_from_an_old_one_is_refused(spark, tmp_path):
    root = str(tmp_path)
    publication.publish_set(one(spark, 1), root, ("t",), expected=None)
    first = publication.current_set(spark, root)
    publication.publish_set(one(spark, 2), root, ("t",), expected=first)
    with pytest.raises(publication.SetConflictError):
        publication.publish_set(one(spark, 3), root, ("t",), expected=first)
    assert publication.scan_published(spark, root, "t").count() == 2
    assert len([n for n in os.listdir(root) if n.startswith("set-")]) == 2


def test_a_writer_that_dies_behind_its_claim_is_finished(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publication.publish_set(one(spark, 1), root, ("t",), expected=None)
    first = publication.current_set(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(publication, "_commit", killed)
        patch.setattr(publication, "_delete", lambda *_: None)  # it cannot clean up either
        with pytest.raises(KeyboardInterrupt):
            publication.publish_set(one(spark, 2), root, ("t",), expected=first)
    assert publication.current_set(spark, root) == first
    # its set is complete and claimed the number: the next writer commits it and starts from there
    publication.update_set(spark, root, ("t",), lambda before: {"t": before["t"].unionByName(spark.range(1))})
    assert publication.scan_published(spark, root, "t").count() == 3


def test_a_claim_that_was_given_up_is_passed_by(spark, tmp_path):
    root = str(tmp_path)
    publication.publish_set(one(spark, 1), root, ("t",), expected=None)
    assert publication.create_once(spark, f"{root}/_CLAIM-0000000002", "0000000002-gone")
    assert not publication.create_once(spark, f"{root}/_CLAIM-0000000002", "other")
    assert publication.read_text(spark, f"{root}/_CLAIM-0000000002") == "0000000002-gone"
    publication.update_set(spark, root, ("t",), lambda before: {"t": before["t"].unionByName(spark.range(1))})
    assert publication.scan_published(spark, root, "t").count() == 2
    assert publication.current_set(spark, root).startswith("0000000003-")
