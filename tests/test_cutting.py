"""What cleaning text and cutting pages cost, and that they come out as before."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from snapharbor.functions.text import WHITESPACE, strip
from snapharbor.plans import ingestion
from snapharbor.sources import raw as raw_source


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_strip_looks_at_the_ends_first(spark):
    random.seed(5)
    marks = [*WHITESPACE, *"abZ,.!~\x7f\x00é€𝄞"]
    texts = ["".join(random.choices(marks, k=random.randint(0, 6))) for _ in range(5_000)]
    rows = spark.createDataFrame([(None,), *[(t,) for t in texts]], "t string")
    assert "substring" in plan(rows.select(strip(F.col("t"))))
    assert rows.where(~strip(F.col("t")).eqNullSafe(F.btrim("t", F.lit(WHITESPACE)))).count() == 0


def test_anchors_keep_the_places_they_were_numbered_with(spark, raw, spec, monkeypatch):
    """Only detail rows are placed a second time."""
    placed, real = [], ingestion.detail_pages
    monkeypatch.setattr(ingestion, "detail_pages", lambda *a: placed.append(a) or real(*a))
    vehicles, fuels = raw
    ids = fuels.select(spec.raw_id).distinct()
    pages = ingestion.cut_pages(ids, vehicles, fuels, spec, 2).where("dataset = 'anchors'")
    assert len(placed) == 2
    rows = raw_source.explode_pages(pages.select("page", "chunk", "payload"), "payload", [spec.raw_id])
    found = [tuple(r) for r in rows.orderBy("page", "pos").collect()]
    wanted = sorted(r[0] for r in ids.collect())
    assert found == [(k // 2, 0, k % 2, key) for k, key in enumerate(wanted)]
