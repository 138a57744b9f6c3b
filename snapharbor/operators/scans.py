"""Content scans: secret patterns in text, raw identifiers in outputs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapharbor.session import materialize

# Bits of the filter that cells are held against: 2 MB as a table of words.
FILTER_BITS = 1 << 24

# Credential and path patterns of the repository audit, each with
# literals of which any match must contain one.
AUDIT_PATTERNS = {
    "GitHub token": (r"\b(?:ghp_|github_pat_)[A-Za-z0-9_]+", ("ghp_", "github_pat_")),
    "AWS access key": (r"\bAKIA[0-9A-Z]{16}\b", ("AKIA",)),
    "private key": (r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----", ("-----BEGIN ",)),
    "absolute Windows path": (r"(^|[^A-Za-z])[A-Za-z]:[\\/]", (":\\", ":/")),
    "absolute user-home path": (r"/(?:home|Users)/[^/\s]+(?:/|\\)", ("/home/", "/Users/")),
}
# Fixed value: paths that must not be published.
PROHIBITED_PATH = (
    r"(?i)((^|/)(data|\.state|\.venv|logs)(/|$)"
    r"|(^|/)\.env$"
    r"|(^|/)dbt/(target|logs|dbt_packages)(/|$)"
    r"|(^|/)dbt/(\.user\.yml|package-lock\.yml)$"
    r"|\.(duckdb|parquet|log)$"
    r"|privacy_salt"
    r"|\.pbi$)"
)


def scan_patterns(
    df: DataFrame,
    id_col: str,
    text_col: str,
    patterns: dict[str, tuple[str, tuple[str, ...]]] | None = None,
) -> DataFrame:
    """(id, label) for every pattern found anywhere in the whole text; no exchange.

    A pattern is tried only on texts that hold one of its literals.
    """
    text = F.col(text_col)

    def found(pattern: str, literals: tuple[str, ...]) -> Column:
        hit = text.rlike(pattern)
        if not literals:
            return hit
        return reduce(or_, [F.contains(text, F.lit(x)) for x in literals]) & hit

    hits = F.array(
        *[
            F.when(found(*pattern), F.lit(label))
            for label, pattern in (patterns or AUDIT_PATTERNS).items()
        ]
    )
    return df.select(id_col, F.explode(F.array_compact(hits)).alias("label"))


def scan_paths(df: DataFrame, path_col: str) -> DataFrame:
    """Rows whose path must not be published; no exchange."""
    return df.where(F.col(path_col).rlike(PROHIBITED_PATH))


def id_filter(ids: DataFrame, value: str) -> DataFrame:
    """(word, bits): a bit for the hash of every id; at most FILTER_BITS / 64 rows, however many ids."""
    slot = F.xxhash64(value).bitwiseAND(FILTER_BITS - 1)
    bit = F.expr(f"shiftleft(1L, cast(xxhash64({value}) & 63 as int))")
    return ids.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def may_be_ids(cells: DataFrame, words: DataFrame, value: str) -> DataFrame:
    """Cells whose bit is set. The filter is broadcast, its size being bounded, so nothing moves."""
    slot = F.shiftright(F.xxhash64(value).bitwiseAND(FILTER_BITS - 1), 6)
    bit = F.expr(f"shiftright(_bits, cast(xxhash64({value}) & 63 as int)) & 1")
    marked = cells.withColumn("_word", slot).join(F.broadcast(words), "_word")
    return marked.where(bit == 1).select(*cells.columns)


def scan_plaintext_values(
    outputs: dict[str, DataFrame], raw_ids: DataFrame, id_col: str
) -> DataFrame:
    """(relation, column, rows) where a text column holds a raw identifier.

    Cells are first held against a bit filter of all ids where they are read, so that hardly any
    but the hits move. (With hundreds of millions of ids the filter lets most cells pass; the result is
    the same.) Values are counted per (relation, column, value) before the lookup, so a value
    repeated in most rows moves as one row.
    """
    ids = raw_ids.select(F.col(id_col).alias("value")).where(F.col("value").isNotNull()).distinct()
    words = materialize(id_filter(ids, "value"), "id-filter")
    parts = []
    for relation, df in outputs.items():
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        if not texts:
            continue
        cells = F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts]
            )
        )
        parts.append(
            df.select(F.lit(relation).alias("relation"), cells.alias("cell")).select(
                "relation", "cell.column", "cell.value"
            )
        )
    cells = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())
    values = (
        may_be_ids(cells, words, "value")
        .groupBy("relation", "column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        values.join(ids, "value", "left_semi")
        .groupBy("relation", "column")
        .agg(F.sum("rows").alias("rows"))
    )
