"""Ordered numbering and keyset pages over data of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from snapharbor.functions.text import not_blank, strip
from snapharbor.session import materialize
from snapharbor.spec import check_page_size

# Input bytes that one range of a global order should hold.
RANGE_BYTES = 256 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60
MOST_RANGES = 100_000
# Rows per chunk in the order check; only one summary row per chunk is compared.
CHUNK_ROWS = 10_000
# Rows that one task may sort, and rows of a sample that find a page's place in an order.
DIRECT_ROWS = 100_000
SAMPLE_ROWS = 10_000
_ROW_BITS = (1 << 33) - 1


def range_count(df: DataFrame) -> int:
    """Ranges for a global order: by the size of the inputs, at least the shuffle default.

    In-memory inputs are of unknown size, which Spark states as a huge one; they add nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(s for s in sizes if s < UNKNOWN_BYTES)
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(default, -(-size // RANGE_BYTES)), MOST_RANGES)


def global_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the total order.

    Range-partition, sort inside partitions, number locally, then add the start of
    each partition. No task sees more than one range, and the trailing row id in
    the range key lets a range boundary fall between equal keys. The numbered rows
    are materialised once, because sampling the ranges a second time could choose
    other boundaries.
    """
    parts = range_count(df)
    numbered = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(_ROW_BITS))
    )
    numbered = materialize(numbered, "positions")
    # At most one row per shuffle partition, so both the window and the broadcast
    # below are bounded by the partition count.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        numbered.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


def total_order(df: DataFrame, order: list[Column]) -> list[Column]:
    """``order`` with all other columns behind it, so that only equal rows tie."""
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return [*order, *[F.col(c) for c in sortable]]


def offset_page(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """LIMIT/OFFSET page in order: no task holds the rows before it, and only the page's
    neighbourhood is sorted.

    Rows that tie in ``order`` go by their other columns, so a page is the same every time. ``df``
    is read a few times, by its order columns only but for the last; store it first if it
    is expensive or not deterministic.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must be zero or positive")
    columns = total_order(df, order)
    if not _selectable(df, columns):
        placed = global_position(df, *columns, name="_pos")
        page = placed.where((F.col("_pos") >= offset) & (F.col("_pos") < offset + limit))
        return page.orderBy("_pos").drop("_pos")
    part, skip, rows = _neighbourhood(df, len(order), columns, offset, limit)
    if min(skip + limit, rows) <= DIRECT_ROWS:
        return part.orderBy(*columns).offset(skip).limit(limit)
    placed = global_position(part, *columns, name="_pos")
    page = placed.where((F.col("_pos") >= skip) & (F.col("_pos") < skip + limit))
    return page.orderBy("_pos").drop("_pos")


def _selectable(df: DataFrame, columns: list[Column]) -> bool:
    """All ascending, and of types whose values can be compared with a literal."""
    ascending = not any(str(c).endswith(("FIRST'>", "LAST'>")) for c in columns)
    kinds = [f.dataType for f in df.select(*columns).schema] if ascending else []
    return ascending and all(isinstance(k, T.AtomicType) and not isinstance(k, T.VariantType) for k in kinds)


def _neighbourhood(
    df: DataFrame, leading: int, columns: list[Column], offset: int, limit: int
) -> tuple[DataFrame, int, int]:
    """Few rows that hold the page, how many of them stand before it, and how many they are.

    A sample says between which two keys the page should be; counting the rows before and
    between them tells whether it is. That is repeated inside, until few rows are left. Keys are
    the order's columns, and further ones where too many rows tie.
    """
    part, skip, width = df, offset, leading
    rows = part.count()
    if skip >= rows:
        return part.limit(0), 0, 0
    while rows > max(DIRECT_ROWS, 2 * limit):
        key = _key(part, columns[:width])
        spread = 4
        while True:
            sample = part.select(key.alias("k")).sample(min(1.0, SAMPLE_ROWS / rows), seed=spread)
            found = [r["k"] for r in sample.orderBy("k").collect()]  # some SAMPLE_ROWS rows
            many = len(found)
            margin = spread * int(many**0.5) + 1
            low = int(skip / rows * many) - margin
            high = int((skip + limit) / rows * many) + margin
            kind = sample.schema["k"].dataType
            above = key >= _literal(found[low], kind) if low >= 0 else F.lit(True)
            upto = key <= _literal(found[high], kind) if high < many else F.lit(True)
            counts = part.agg(
                F.coalesce(F.sum((~above).cast("long")), F.lit(0)).alias("before"),
                F.coalesce(F.sum((above & upto).cast("long")), F.lit(0)).alias("inside"),
            ).first()
            before, inside = counts["before"], counts["inside"]
            if before <= skip and (skip + limit <= before + inside or high >= many):
                break
            spread *= 4
        if inside == rows:
            if width == len(columns):
                break  # all rows are equal, or the sample says no more
            width += 1
            continue
        # the first column by itself can be pushed into a scan
        lead, kind = columns[0], part.select(columns[0]).schema[0].dataType
        plain = F.lit(True)
        if not isinstance(kind, T.TimestampType):
            if low >= 0 and found[low]["k0"] is not None:
                plain = plain & (lead >= F.lit(found[low]["k0"]).cast(kind))
            if high < many and found[high]["k0"] is not None:
                plain = plain & ((lead <= F.lit(found[high]["k0"]).cast(kind)) | lead.isNull())
        part, skip, rows = part.where(plain & above & upto), skip - before, inside
    return part, skip, rows


def _key(df: DataFrame, columns: list[Column]) -> Column:
    """The columns as one value that is compared in order; instants as numbers, which a literal
    gives back exactly."""
    schema = df.select(*columns).schema
    plain = [F.unix_micros(c) if isinstance(f.dataType, T.TimestampType) else c for c, f in zip(columns, schema)]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(plain)])


def _literal(row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kind])


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return offset_page(df, order, 0, n)


def anchor_ids(df: DataFrame, id_col: str, type_col: str, wanted: tuple[str, ...]) -> DataFrame:
    """Distinct stripped ids that have a row of a wanted type."""
    return (
        df.where(F.col(type_col).isin(*wanted))
        .select(strip(F.col(id_col)).alias(id_col))
        .where(F.length(id_col) > 0)
        .distinct()
    )


def keyset_page(
    df: DataFrame,
    id_col: str,
    type_col: str,
    wanted: tuple[str, ...],
    after: str | None = None,
    limit: int = 1_000,
) -> DataFrame:
    """One page of ids after the cursor, in id order."""
    check_page_size(limit)
    rows = df.where(F.col(type_col).isin(*wanted))
    if after is not None:
        rows = rows.where(F.col(id_col) > after)
    return rows.select(id_col).distinct().orderBy(id_col).limit(limit)


def number_pages(ids: DataFrame, id_col: str, page_size: int, name: str = "page") -> DataFrame:
    """Page number and in-page position of every id: the whole keyset sweep at once."""
    check_page_size(page_size)
    return global_position(ids, F.col(id_col), name="_pos").select(
        id_col,
        F.floor(F.col("_pos") / page_size).alias(name),
        (F.col("_pos") % page_size).alias("pos"),
    )


def batch_assign(ids: DataFrame, id_col: str, size: int) -> DataFrame:
    """Blank ids dropped, the rest distinct and sorted, in batches of ``size``."""
    if size < 1:
        raise ValueError("batch size must be positive")
    clean = ids.where(not_blank(F.col(id_col))).select(id_col).distinct()
    return global_position(clean, F.col(id_col), name="_pos").select(
        id_col, F.floor(F.col("_pos") / size).alias("batch")
    )


def snapshot_cap(
    accepted: DataFrame, id_col: str, limit: int | None, order: list[str] | None = None
) -> DataFrame:
    """First ``limit`` accepted ids; no limit keeps all. Rejected ids use up nothing.

    Ids go by themselves, or by the columns ``order`` where they no longer tell the order that they
    came in; of an id that is there more than once the first place counts.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit must be zero or positive")
    if not limit:
        return accepted.select(id_col).distinct()
    if order is None:
        ids = materialize(accepted.select(id_col).distinct(), "accepted")
        return first_rows(ids, [F.col(id_col)], limit)
    places = accepted.groupBy(id_col).agg(F.min(F.struct(*order)).alias("_at"))
    places = materialize(places.select(id_col, *[F.col(f"_at.{c}").alias(c) for c in order]), "accepted")
    return first_rows(places, [F.col(c) for c in order], limit).select(id_col)


def resume_cursor(
    pages: DataFrame, commits: DataFrame, id_col: str, page_col: str = "page"
) -> DataFrame:
    """Id after which a broken-off run goes on; NULL if it must begin anew.

    ``pages`` holds (page, id), ``commits`` (page, committed, digest, landed_digest). A
    page counts if it was committed and the payload that lies in raw storage still has
    the digest it was committed with. The run goes on behind the last page before the
    first one that does not count; later pages are fetched again.
    """
    counts = F.col("committed") & F.col("digest").eqNullSafe(F.col("landed_digest"))
    sound = F.coalesce(counts & F.col("digest").isNotNull(), F.lit(False))
    gap = commits.where(~sound).agg(F.min(page_col).alias("gap")).scalar()
    known = commits.where(sound).select(F.col(page_col)).distinct()
    usable = pages.where(not_blank(F.col(id_col))).join(known, page_col, "left_semi")
    before = usable.where(gap.isNull() | (F.col(page_col) < gap))
    return before.agg(
        F.max_by(strip(F.col(id_col)), F.struct(page_col, strip(F.col(id_col)))).alias("cursor")
    )


def page_order_guard(
    pages: DataFrame, id_col: str, page_col: str = "page", pos_col: str = "pos"
) -> DataFrame:
    """Ids that break the keyset contract.

    ``not_increasing``: not above the id before it in its page. ``not_advanced``: the
    first id of a page is not above the last id of the last earlier page that has one,
    whatever pages are missing or empty between them. Neighbours are compared inside
    fixed-size chunks, then chunk ends, then page ends in blocks of pages, then block
    ends, so an oversized page or a long run spreads over many tasks.
    """
    ident = strip(F.col(id_col))
    rows = pages.where(not_blank(F.col(id_col))).select(
        F.col(page_col).cast("long").alias("page"),
        F.col(pos_col).cast("long").alias("pos"),
        F.floor(F.col(pos_col) / CHUNK_ROWS).alias("chunk"),
        ident.alias("id"),
    )
    in_chunk = Window.partitionBy("page", "chunk").orderBy("pos")
    inside = rows.withColumn("prev_id", F.lag("id").over(in_chunk)).where(
        F.col("id") <= F.col("prev_id")
    )
    chunks = rows.groupBy("page", "chunk").agg(
        F.min("pos").alias("pos"),
        F.min_by("id", "pos").alias("id"),
        F.max_by("id", "pos").alias("last_id"),
    )
    by_page = Window.partitionBy("page").orderBy("chunk")
    between = chunks.withColumn("prev_id", F.lag("last_id").over(by_page)).where(
        F.col("id") <= F.col("prev_id")
    )
    ends = chunks.groupBy("page").agg(
        F.min("pos").alias("pos"),
        F.min_by("id", "chunk").alias("id"),
        F.max_by("last_id", "chunk").alias("last_id"),
    )
    ends = ends.withColumn("block", F.floor(F.col("page") / CHUNK_ROWS))
    in_block = Window.partitionBy("block").orderBy("page")
    neighbours = ends.withColumn("prev_id", F.lag("last_id").over(in_block))
    block_ends = ends.groupBy("block").agg(F.max_by("last_id", "page").alias("last_id"))
    # One row per block of pages that has an id.
    earlier = block_ends.select(
        "block", F.lag("last_id").over(Window.orderBy("block")).alias("before_block")
    )
    pages_apart = (
        neighbours.join(F.broadcast(earlier), "block")
        .withColumn("prev_id", F.coalesce("prev_id", "before_block"))
        .where(F.col("id") <= F.col("prev_id"))
    )
    shape = ["page", "pos", "id", "prev_id"]
    return (
        inside.select(*shape, F.lit("not_increasing").alias("violation"))
        .unionByName(between.select(*shape, F.lit("not_increasing").alias("violation")))
        .unionByName(pages_apart.select(*shape, F.lit("not_advanced").alias("violation")))
    )


def running_totals(
    df: DataFrame, run_col: str, order_col: str, sums: list[str], block: int = CHUNK_ROWS
) -> DataFrame:
    """Cumulative sums per run over a dense integer order.

    Sums inside fixed-size blocks, then adds the totals of the earlier blocks, so a
    run of any length is spread over as many tasks as it has blocks.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order_col) / block))
    inside = (
        Window.partitionBy(run_col, "_block")
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = blocked.groupBy(run_col, "_block").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = (
        Window.partitionBy(run_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.select(
        run_col,
        "_block",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in sums],
    )
    local = blocked.select(
        "*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in sums]
    )
    joined = local.join(starts, [run_col, "_block"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_s_{c}") + F.col(f"_l_{c}")).alias(f"total_{c}") for c in sums],
    )
