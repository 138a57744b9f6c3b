"""Small inputs with awkward rows, shared by the tests of the llm operators."""

from __future__ import annotations

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use themselves.
CLASHING = ["id", "row", "sig", "kind", "part", "place", "n", "score", "_row", "_id", "_entities", "_text_key"]
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text)."""
    if not clashing:
        return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(
        [(i, t, "en", "s", None, *(f"{c}{i}" for c in CLASHING)) for i, t in rows], f"{DOCS}, {extra}"
    )


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{k}" for k in rng.integers(0, vocabulary, n))


def collected(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
