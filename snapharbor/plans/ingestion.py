"""The ingestion job: land, check, ingest, stage and publish one run.

What a run leaves behind is durable: raw payloads and manifest, an ingestion log, and
staging tables, runs and models as published sets, each replaced by one commit. The run's row
says how far it has come:

=====================  =====================  ==========================================
status                 checkpoint_status      what is done
=====================  =====================  ==========================================
running                in_progress            part of the pages, perhaps
failed                 failed                 the same, and an error
transforming           staging_complete       all pages are staged; nothing else is needed
transformation_failed  transformation_failed  the same, and an error
finalizing             staging_complete       the models are published
succeeded              completed              everything
=====================  =====================  ==========================================

A job that broke off at any point is started again with the same run id and goes on from there.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapharbor.functions.text import strip
from snapharbor.operators.paging import number_pages, page_order_guard, resume_cursor
from snapharbor.operators.payloads import detail_pages, page_digest
from snapharbor.operators.quality import DataQualityError
from snapharbor.operators.runs import evolve_runs, run_upsert
from snapharbor.operators.upsert import EmptySnapshotError
from snapharbor.plans.workflow import SnapshotResult, transform_only
from snapharbor.session import configure, materialize, stored_meanwhile
from snapharbor.sources.publication import (
    create_once,
    current_set,
    publish_set,
    read_text,
    scan_published,
    update_set,
)
from snapharbor.sources.raw import (
    PAYLOADS_PER_FILE,
    explode_pages,
    land_raw_pages,
    manifest_path,
    next_arrival,
    path_exists,
    read_manifest,
    stored_payloads,
    verify_run,
    with_payload,
)
from snapharbor.sources.tables import output_inventory
from snapharbor.spec import INGESTION_RUNS, PUBLISHED_RELATIONS, SnapshotSpec
from snapharbor.streaming.ingest import COUNTED, counted_pages, settle, stream_page_ingest

STAGED = ("fuels", "ingestion_runs", "vehicles")


@dataclass(frozen=True)
class Folders:
    """Where a warehouse keeps what."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    def log(self, run: str) -> str:
        return f"{self.root}/log/{run}"

    def settings(self, run: str) -> str:
        return f"{self.root}/settings/{run}.json"

    def result(self, run: str) -> str:
        return f"{self.root}/results/{run}.json"

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    @property
    def published(self) -> str:
        return f"{self.root}/published"


def cut_pages(
    anchors: DataFrame, vehicles: DataFrame, fuels: DataFrame, spec: SnapshotSpec, page_size: int
) -> DataFrame:
    """Payloads of the whole sweep, as the pages of a run would arrive.

    ``anchors`` holds distinct ids. Detail rows follow the page of their id and are cut into
    chunks of the page size.
    """
    # Ids in order compress so well that Spark would take millions of them for a small table: a
    # broadcast of them fills every executor, so they are merged.
    key = spec.raw_id
    numbered = materialize(number_pages(anchors, key, page_size), "anchors")
    ids = numbered.select(key, "page")
    # The anchors have their places already: a page of them is one chunk.
    cut = numbered.withColumn("chunk", F.lit(0).cast("long"))
    parts = [page_digest(cut, ["page", "chunk"], "pos", [key]).withColumn("dataset", F.lit("anchors"))]
    sets = (
        ("vehicles", vehicles, spec.raw_vehicle_columns, []),
        ("fuels", fuels, spec.raw_fuel_columns, [spec.raw_sequence]),
    )
    for dataset, rows, columns, order in sets:
        rows = rows.withColumn("_id", strip(F.col(key)))
        rows = rows.join(ids.withColumnRenamed(key, "_id").hint("merge"), "_id")
        cut = detail_pages(rows, "page", ["_id", *order], page_size)
        pages = page_digest(cut, ["page", "chunk"], "pos", columns)
        parts.append(pages.withColumn("dataset", F.lit(dataset)))
    return reduce(DataFrame.unionByName, parts)


class ResumeError(ValueError):
    """A run cannot go on: its settings differ from those it was started with."""


def read_runs(spark: SparkSession, folders: Folders) -> DataFrame:
    if current_set(spark, folders.runs) is None:
        return spark.createDataFrame([], INGESTION_RUNS)
    return scan_published(spark, folders.runs, "ingestion_runs")


def save_run(spark: SparkSession, folders: Folders, run: dict) -> DataFrame:
    """Create or replace one run row; other columns keep what the run held before.

    Of two jobs that save at once, the second one computes its table again from that of the first.
    """

    def change(before: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
        table = spark.createDataFrame([], INGESTION_RUNS) if before is None else before["ingestion_runs"]
        runs = evolve_runs(table)
        held = runs.where(F.col("ingestion_id") == run["ingestion_id"]).first()
        row = {**(held.asDict() if held else dict.fromkeys(INGESTION_RUNS.names)), **run}
        changed = spark.createDataFrame([row], INGESTION_RUNS).withColumn("sequence", F.lit(0))
        return {"ingestion_runs": run_upsert(runs, changed)}

    update_set(spark, folders.runs, ("ingestion_runs",), change)
    return scan_published(spark, folders.runs, "ingestion_runs")


def settings_digest(spec: SnapshotSpec) -> str:
    """What must not change while a run is under way: field names, labels and the salt."""
    return hashlib.sha256(json.dumps(asdict(spec), sort_keys=True, default=str).encode()).hexdigest()


def check_settings(
    spark: SparkSession, folders: Folders, spec: SnapshotSpec, run: str, limit: int | None, page_size: int | None
) -> None:
    """Note the settings of a run when it starts, and refuse others when it goes on."""
    now = {"limit": limit, "page_size": page_size, "settings": settings_digest(spec)}
    path = folders.settings(run)
    if create_once(spark, path, json.dumps(now)):
        return
    before = json.loads(read_text(spark, path))
    for name, said in (("limit", "limit"), ("page_size", "page size"), ("settings", "configuration")):
        if before[name] != now[name]:
            raise ResumeError(f"cannot resume {run}: its {said} differs")


def snapshot_job(
    spark: SparkSession,
    pages: DataFrame | None,
    root: str,
    spec: SnapshotSpec,
    run: str,
    now=datetime.now,
    limit: int | None = None,
    page_size: int | None = None,
) -> SnapshotResult:
    """Ingest the pages of one run and publish its models, replacing the snapshot before.

    ``pages`` are the payloads fetched so far (see ``cut_pages``). A job that failed leaves a
    run row that says so and the published set as it was; called again with all or only the
    missing pages of the run it resumes. Once all pages are staged none are looked at, and they
    may be None. A run that has succeeded is not run again: its result is returned. ``limit`` takes the
    first complete vehicles (see ``settle``). A run keeps the limit, page size and spec that it began with.
    """
    configure(spark, steps=True)
    folders = Folders(root)
    before = read_runs(spark, folders).where(F.col("ingestion_id") == run).first()
    check_settings(spark, folders, spec, run, limit, page_size)
    if before is not None and before["status"] == "succeeded":
        return published_result(spark, folders, run)
    resumed = before is not None
    staged = resumed and before["checkpoint_status"] in ("staging_complete", "transformation_failed")
    started = before["started_at"] if resumed else now()
    begun = now()
    spent = (before["active_duration_seconds"] or 0.0) if resumed else 0.0
    state = {
        "ingestion_id": run, "started_at": started, "error_message": None, "completed_at": None,
        "status": "transforming" if staged else "running",
        "checkpoint_status": "staging_complete" if staged else "in_progress",
        "ingestion_mode": "resumable_snapshot", "requested_limit": limit, "sample_limit": limit or 0,
        "page_size": page_size, "resumed": resumed,
        "resume_count": (before["resume_count"] or 0) + 1 if resumed else 0,
    }

    def seconds() -> float:
        return spent + (now() - begun).total_seconds()

    save_run(spark, folders, state)
    try:
        if not staged:
            if pages is None:
                raise ResumeError(f"run {run} has pages to land, but none were given")
            arrival = next_arrival(spark, folders.raw, run)
            with stored_meanwhile(pages, "pages", PAYLOADS_PER_FILE) as stored:
                land_raw_pages(stored, folders.raw, run, arrival=arrival)
            state |= ingest_run(spark, folders, spec, run)
            tables = settle(spark, folders.log(run), limit)
            stage_run(spark, folders, tables, save_run(spark, folders, state))
            if limit:
                state |= capped_counts(spark, folders)
            staged = True
            state |= {"status": "transforming", "checkpoint_status": "staging_complete"}
            save_run(spark, folders, {**state, "active_duration_seconds": seconds()})
        elif not is_staged(spark, folders, run):
            # another run was staged meanwhile; this one's log is complete
            stage_run(spark, folders, settle(spark, folders.log(run), limit), read_runs(spark, folders))
        result = transform_only(spark, staged_tables(spark, folders), folders.published, spec)
        state |= {"status": "finalizing"}
        saved = save_run(spark, folders, state)
        row = saved.where(F.col("ingestion_id") == run).first()
        done = row["matched_vehicles"] + row["fuel_rows"]
        state |= {
            "status": "succeeded", "checkpoint_status": "completed", "completed_at": now(),
            "active_duration_seconds": seconds(),
            "wall_clock_elapsed_seconds": max(0.0, (now() - started).total_seconds()),
            "processed_rows_per_second": done / seconds() if seconds() > 0 else 0.0,
        }
        save_run(spark, folders, state)
        create_once(spark, folders.result(run), json.dumps(asdict(result)))
        return result
    except Exception as error:
        kind = "transformation_failed" if staged else "failed"
        failed = {"status": kind, "checkpoint_status": kind, "completed_at": now()}
        failed |= {"active_duration_seconds": seconds(), "error_message": str(error)[:1000]}
        save_run(spark, folders, {**state, **failed})
        raise


def transform_staged(spark: SparkSession, root: str, spec: SnapshotSpec) -> SnapshotResult:
    """Build, test and publish the models of whatever is staged. Runs and staging stay as they are."""
    configure(spark, steps=True)
    folders = Folders(root)
    return transform_only(spark, staged_tables(spark, folders), folders.published, spec)


def stage_run(spark: SparkSession, folders: Folders, tables: dict[str, DataFrame], runs: DataFrame) -> None:
    publish_set({**tables, "ingestion_runs": runs}, folders.staging, STAGED)


def staged_tables(spark: SparkSession, folders: Folders) -> dict[str, DataFrame]:
    return {n: scan_published(spark, folders.staging, n) for n in STAGED}


def is_staged(spark: SparkSession, folders: Folders, run: str) -> bool:
    """Whether staging holds this run; all its rows carry one run id."""
    if current_set(spark, folders.staging) is None:
        return False
    first = scan_published(spark, folders.staging, "vehicles").select("ingestion_id").first()
    return first is not None and first["ingestion_id"] == run


def capped_counts(spark: SparkSession, folders: Folders) -> dict:
    """Counters of what a limit has left of the run."""
    rows = {n: scan_published(spark, folders.staging, n).count() for n in ("vehicles", "fuels")}
    return {"matched_vehicles": rows["vehicles"], "vehicle_rows": rows["vehicles"], "fuel_rows": rows["fuels"]}


def published_result(spark: SparkSession, folders: Folders, run: str) -> SnapshotResult:
    """What a run that succeeded has published."""
    said = read_text(spark, folders.result(run))
    if said is not None:
        return SnapshotResult(**json.loads(said))
    # broken off just behind its last save: what is published is counted again
    published = {r: scan_published(spark, folders.published, r) for r in PUBLISHED_RELATIONS}
    rows = {r["relation"]: r["rows"] for r in output_inventory(published, PUBLISHED_RELATIONS).collect()}
    return SnapshotResult({}, rows, [])


def ingest_run(spark: SparkSession, folders: Folders, spec: SnapshotSpec, run: str) -> dict:
    """Check what a run has landed and ingest it; returns the counters of its run row."""
    if not verify_run(spark, folders.raw, run).isEmpty():
        raise DataQualityError("raw storage has lost or damaged payloads of this run")
    check_order(anchor_pages(spark, folders, spec, run), spec.raw_id)
    stream_page_ingest(spark, folders.raw, folders.log(run), spec, run).awaitTermination()
    totals = counted_pages(spark, folders.log(run)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTED], F.count(F.lit(1)).alias("pages")
    )
    found = totals.first()
    if not found["matched"]:
        raise EmptySnapshotError("the run holds no complete vehicle")
    repeated = read_manifest(spark, folders.raw, run).where("duplicate").count()
    return {
        "pages_requested": found["pages"], "source_rows_received": found["source_rows"],
        "matched_vehicles": found["matched"], "rejected_rows": found["rejected"],
        "vehicle_rows": found["matched"], "fuel_rows": found["fuel_rows"],
        "duplicate_payloads": repeated,
    }


def anchor_pages(spark: SparkSession, folders: Folders, spec: SnapshotSpec, run: str) -> DataFrame:
    """(page, pos, id) of the run's anchor pages; of a page that arrived again, its last arrival.

    The chunks of a page follow one another, so they are one sequence of positions.
    """
    named = read_manifest(spark, folders.raw, run).where(F.col("dataset") == "anchors")
    last = named.groupBy("page").agg(F.max("arrival").alias("arrival"))
    named = materialize(named.join(last, ["page", "arrival"], "left_semi"), "named")
    payloads = stored_payloads(spark, folders.raw).where(F.col("dataset") == "anchors")
    pages = with_payload(named, payloads).select("page", "chunk", "payload")
    rows = explode_pages(pages, "payload", [spec.raw_id])
    return rows.withColumn("pos", F.shiftleft("chunk", 32) + F.col("pos")).drop("chunk")


def run_cursor(spark: SparkSession, root: str, spec: SnapshotSpec, run: str) -> str | None:
    """The id behind which a broken-off run fetches its next anchor page; None from the start.

    A page counts if its anchor payload is in raw storage with the digest of the manifest; the
    cursor is the last id before the first page that does not count (see ``resume_cursor``).
    """
    folders = Folders(root)
    if not path_exists(spark, manifest_path(folders.raw, run)):
        return None
    named = read_manifest(spark, folders.raw, run).where(F.col("dataset") == "anchors")
    key = ["stored_in", "block", "dataset", "payload_sha256"]
    payloads = stored_payloads(spark, folders.raw).where(F.col("dataset") == "anchors")
    sound = payloads.where(F.sha2("payload", 256) == F.col("payload_sha256")).select(*key).distinct()
    landed = named.join(sound.withColumn("landed_digest", F.col("payload_sha256")), key, "left")
    last = Window.partitionBy("page").orderBy(F.desc("arrival"))
    landed = landed.withColumn("_rank", F.rank().over(last)).where("_rank = 1")
    commits = landed.groupBy("page").agg(
        F.lit(True).alias("committed"),
        F.max("payload_sha256").alias("digest"),
        # a page of several chunks counts if all of them are there
        F.when(F.count("landed_digest") == F.count(F.lit(1)), F.max("payload_sha256")).alias("landed_digest"),
    )
    pages = anchor_pages(spark, folders, spec, run)
    return resume_cursor(pages, materialize(commits, "commits"), spec.raw_id).first()["cursor"]


def check_order(anchors: DataFrame, id_col: str) -> None:
    """Refuse anchor pages (page, pos, id) that break the keyset order."""
    if not page_order_guard(anchors, id_col).isEmpty():
        raise DataQualityError("anchor pages are out of order")
