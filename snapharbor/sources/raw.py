"""Raw pages: storing payloads, reading, projecting and checking them.

A raw folder has two tables. ``payloads`` holds each distinct payload once, as a row of
Parquet in the partition of the run that brought it first. ``manifest`` holds, per run, a
row for every page that arrived, with the digest of its payload. A run is what its
manifest says, so it neither sees pages of other runs nor loses unchanged ones.

What lands together is cut into blocks of whole pages in page order. The payloads of a block are
one partition and its manifest rows one file, which names the blocks that hold the payloads. So
whoever works through a run block by block opens a block's own folders and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapharbor.operators.joins import join_reduced, lookup_join
from snapharbor.operators.paging import running_totals
from snapharbor.operators.payloads import ledger_insert
from snapharbor.session import materialize
from snapharbor.spec import MANIFEST, PAYLOADS, text_schema

# Payloads of a block, which a micro-batch of the stream takes at a time. A page is never cut,
# so a block may hold more by what belongs to one page.
PAGES_PER_FILE = 1_000
# Payloads of a file: a reader holds a batch of rows of one file, and a payload may be megabytes.
PAYLOADS_PER_FILE = 32
# Payloads of one dataset that a task sorts and writes, at most about.
PAYLOADS_PER_TASK = 128
# Partitions that are opened by name at most; beyond that whole runs are read.
MOST_PLACES = 10_000
PLACE = "stored_in string, block string"


def payload_path(root: str) -> str:
    return f"{root}/payloads"


def manifest_path(root: str, run: str) -> str:
    return f"{root}/manifest/run={run}"


def verified_path(root: str) -> str:
    return f"{root}/verified"


def stored_payloads(spark: SparkSession, root: str) -> DataFrame:
    """All stored payloads; none before the first run."""
    if not path_exists(spark, payload_path(root)):
        return spark.createDataFrame([], PAYLOADS)
    return spark.read.schema(PAYLOADS).parquet(payload_path(root))


def block_payloads(spark: SparkSession, root: str, places: Iterable[tuple[str, str]]) -> DataFrame:
    """Payloads of the named (run, block) partitions. No other folder is listed or read."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folders = [
        f"{payload_path(root)}/stored_in={escape(run)}/block={escape(block)}" for run, block in sorted(places)
    ]
    if not folders:
        return spark.createDataFrame([], PAYLOADS)
    return spark.read.schema(PAYLOADS).option("basePath", payload_path(root)).parquet(*folders)


def payload_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, payload_sha256, stored_in, block) of every payload seen so far; reads no payload."""
    return stored_payloads(spark, root).select("dataset", "payload_sha256", "stored_in", "block")


def page_slots(pages: DataFrame, pages_per_file: int) -> DataFrame:
    """(page, number, part): whole pages, in order, in runs of about ``pages_per_file`` payloads, and
    these in parts of about ``PAYLOADS_PER_TASK``."""
    sizes = pages.groupBy(F.col("page").cast("long").alias("page")).agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.withColumn("_run", F.lit(0)), "page-sizes")
    upto = running_totals(sizes, "_run", "page", ["n"])
    before = F.col("total_n") - F.col("n")
    part = F.floor(before % pages_per_file / PAYLOADS_PER_TASK)
    return upto.select("page", F.floor(before / pages_per_file).alias("number"), part.alias("part"))


def land_raw_pages(
    pages: DataFrame, root: str, run: str, arrival: int = 0, pages_per_file: int = PAGES_PER_FILE
) -> None:
    """Store the payloads that no run has brought yet, and name all pages in the manifest.

    ``pages`` has (dataset, page, chunk, payload_sha256, row_count, payload). A resumed run
    lands its further pages with a higher ``arrival``; of a page that arrived again the
    last arrival counts. A landing that broke off left payloads that no manifest names; they
    are known to the next one.
    """
    spark = pages.sparkSession
    landing = uuid.uuid4().hex[:12]
    pages = pages.withColumn("stored_in", F.lit(run)).withColumn("page", F.col("page").cast("long"))
    slots = page_slots(pages, pages_per_file)
    slots = slots.select("page", F.format_string(f"{landing}-%08d", "number").alias("slot"), "part")
    pages = lookup_join(pages, slots, "page", "inner").withColumn("block", F.col("slot"))
    ledger = materialize(payload_ledger(spark, root), "ledger")
    _, flagged = ledger_insert(ledger, pages.drop("payload", "part"), ["page", "chunk"])
    flagged = materialize(flagged, "arrivals")
    # Payloads are read where the pages are and move once, to their block.
    new = flagged.where(~F.col("duplicate"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("dataset", "payload_sha256", "page", "chunk")]
    first = materialize(new.select("dataset", "payload_sha256", "page", "chunk").distinct(), "new-payloads")
    fresh = pages.alias("p").join(first.alias("n"), same, "left_semi")
    # A task sorts what it writes: a block goes to several, and so does what one page has inflated.
    spread = F.floor(F.col("chunk") / min(pages_per_file, PAYLOADS_PER_TASK))
    (
        fresh.repartition("slot", "dataset", "part", spread)
        .select(*PAYLOADS.names)
        .write.partitionBy("stored_in", "block", "dataset")
        .mode("append")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", PAYLOADS_PER_FILE)
        .parquet(payload_path(root))
    )
    key = ["dataset", "payload_sha256"]
    known = ledger.unionByName(new.select(*ledger.columns))
    named = join_reduced(flagged.drop("stored_in", "block"), known, key)
    named = named.withColumn("arrival", F.lit(arrival))
    named = named.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST])
    named.repartition("slot").write.partitionBy("slot").mode("append").parquet(
        manifest_path(root, run)
    )


def read_manifest(spark: SparkSession, root: str, run: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(manifest_path(root, run))


def next_arrival(spark: SparkSession, root: str, run: str) -> int:
    """The number of the run's next landing: one more than the last that its manifest names."""
    if not path_exists(spark, manifest_path(root, run)):
        return 0
    last = read_manifest(spark, root, run).agg(F.max("arrival")).first()[0]
    return 0 if last is None else last + 1


def payload_places(manifest: DataFrame) -> set[tuple[str, str]]:
    """The (run, block) partitions that hold the payloads of the few manifest rows of a batch."""
    return {tuple(r) for r in manifest.select("stored_in", "block").collect()}


def with_payload(manifest: DataFrame, payloads: DataFrame) -> DataFrame:
    """Manifest rows with their payload."""
    key = ["stored_in", "block", "dataset", "payload_sha256"]
    return manifest.join(payloads.select(*key, "payload"), key)


def scan_pages(spark: SparkSession, root: str, run: str, dataset: str, columns: list[str]) -> DataFrame:
    """Rows of one dataset as a run holds it, with page and position."""
    named = read_manifest(spark, root, run).where(F.col("dataset") == dataset)
    payloads = stored_payloads(spark, root).where(F.col("dataset") == dataset)
    pages = with_payload(named, payloads).select("page", "chunk", "payload")
    return explode_pages(pages, "payload", columns)


def scan_raw_json(
    spark: SparkSession, path: str, columns: list[str], wholetext: bool = True
) -> DataFrame:
    """Rows of page files, each one JSON array of objects, with file and position.

    Values are read as text. A file that is not an array of objects fails the read.
    Files are pages, so the size of one is bounded by the page size. Without
    ``wholetext`` every line of a file is a page.
    """
    pages = spark.read.text(path, wholetext=wholetext).select(
        F.input_file_name().alias("file"), F.btrim("value", F.lit(" \t\r\n")).alias("body")
    )
    return explode_pages(pages, "body", columns)


def explode_pages(pages: DataFrame, body: str, columns: list[str]) -> DataFrame:
    """One row per object of the JSON array in ``body``, numbered inside its page."""
    return exploded(pages, body, page_rows(body, columns))


def exploded(pages: DataFrame, body: str, rows: tuple[Column, Column]) -> DataFrame:
    """``explode_pages`` with columns from ``page_rows``; whoever reads pages often builds them once."""
    parsed, numbered = rows
    keep = [c for c in pages.columns if c != body]
    # A column of its own: named twice in one expression, the text would be parsed twice.
    found = pages.select(*keep, parsed.alias("_rows")).select(*keep, numbered.alias("pos", "row"))
    return found.select(*keep, "pos", "row.*")


def page_rows(body: str, columns: list[str]) -> tuple[Column, Column]:
    """The rows of a page as an array, and these one by one with their positions."""
    schema = T.ArrayType(text_schema(columns))
    rows = F.from_json(F.col(body), schema, {"mode": "FAILFAST"})
    checked = F.when(F.col(body).rlike(r"^\[\s*(\{|\]$)"), rows).otherwise(
        F.raise_error(F.lit("a raw page is not a JSON array of objects")).cast(schema)
    )
    # An element that is null would come out as a row of NULLs.
    whole = F.coalesce(F.forall("_rows", lambda x: x.isNotNull()), F.lit(True))
    sound = F.when(whole, F.col("_rows")).otherwise(
        F.raise_error(F.lit("a raw page is not an array of objects: it holds null")).cast(schema)
    )
    return checked, F.posexplode(sound)


def raw_integrity_scan(
    spark: SparkSession, root: str, places: Iterable[tuple[str, str]] | None = None
) -> DataFrame:
    """(dataset, digest, ok) of each stored payload: all its bytes must give its digest.

    With ``places`` only those (run, block) partitions are read.
    """
    payloads = stored_payloads(spark, root) if places is None else block_payloads(spark, root, places)
    sound = F.sha2("payload", 256).eqNullSafe(F.col("payload_sha256"))
    return payloads.select("dataset", F.col("payload_sha256").alias("digest"), sound.alias("ok"))


def unverified_places(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(stored_in, block) partitions that the manifest names and no check has found sound."""
    named = manifest.select("stored_in", "block").distinct()
    if not path_exists(spark, verified_path(root)):
        return named
    sound = spark.read.schema(PLACE).parquet(verified_path(root)).distinct()
    return named.join(sound, ["stored_in", "block"], "left_anti")


def verify_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Digests of a run's payloads that are lost or damaged, at most once per digest.

    Only partitions that the run's manifest names and that no earlier check found sound are
    read. Those without a fault are recorded, so the cost of a check is what is new.
    """
    manifest = read_manifest(spark, root, run)
    places = materialize(unverified_places(spark, root, manifest), "unverified")
    named = places.limit(MOST_PLACES + 1).collect()
    if not named:
        return manifest.select("payload_sha256").limit(0)
    if len(named) <= MOST_PLACES:
        payloads = block_payloads(spark, root, [tuple(r) for r in named])
    else:
        runs = [r[0] for r in places.select("stored_in").distinct().collect()]
        payloads = stored_payloads(spark, root).where(F.col("stored_in").isin(runs))
    sound = F.sha2("payload", 256).eqNullSafe(F.col("payload_sha256"))
    key = ["stored_in", "block", "dataset", "payload_sha256"]
    found = payloads.where(sound).select(*key).distinct()
    expected = manifest.join(places, ["stored_in", "block"], "left_semi").select(*key).distinct()
    lost = materialize(expected.join(found, key, "left_anti"), "lost")
    sound_places = places.join(lost, ["stored_in", "block"], "left_anti")
    sound_places.coalesce(1).write.mode("append").parquet(verified_path(root))
    return lost.select("payload_sha256").distinct()


def path_exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def missing_pages(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected digests without a sound payload."""
    sound = landed.where("ok").select(F.col("digest").alias("payload_sha256"))
    return expected.join(sound.distinct(), "payload_sha256", "left_anti")


def projected_source_scan(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the named columns; the scan reads nothing else."""
    return df.select(*columns)


def filtered_source_scan(
    df: DataFrame,
    id_col: str,
    wanted: dict[str, list],
    after: object | None = None,
    limit: int | None = None,
) -> DataFrame:
    """IN lists, cursor, order and limit, all of them offered to the scan."""
    for column, values in wanted.items():
        df = df.where(F.col(column).isin(*values))
    if after is not None:
        df = df.where(F.col(id_col) > F.lit(after))
    return df if limit is None else df.orderBy(id_col).limit(limit)
