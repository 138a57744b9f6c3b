"""What a micro-batch and a page cost, and that they come out as before."""

from __future__ import annotations

from snapharbor.plans import ingestion
from snapharbor.sources import raw as raw_source
from snapharbor.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_stream_builds_its_columns_once(spark, raw, spec, tmp_path, monkeypatch):
    """However many batches there are; and none of them starts a Python worker to write a row."""
    built, made = [], []
    real, create = ingest.salted_sha256, type(spark).createDataFrame
    monkeypatch.setattr(ingest, "salted_sha256", lambda *a, **k: built.append(a) or real(*a, **k))
    vehicles, fuels = raw
    pages = ingestion.cut_pages(fuels.select(spec.raw_id).distinct(), vehicles, fuels, spec, 2)
    root, log = str(tmp_path / "raw"), str(tmp_path / "log")
    raw_source.land_raw_pages(pages, root, "run-1", pages_per_file=1)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: made.append(a) or create(*a, **k))
    ingest.stream_page_ingest(spark, root, log, spec, "run-1", 1).awaitTermination()
    monkeypatch.undo()
    assert ingest.batch_totals(spark, log).count() > 1
    assert len(built) == 1 and made == []


def test_a_page_is_parsed_once(spark):
    pages = spark.createDataFrame([(1, '[{"a": "x"}, {"a": "y"}]')], "page int, body string")
    rows = raw_source.explode_pages(pages, "body", ["a"])
    assert plan(rows).count("from_json(") == 1
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 0, "x"), (1, 1, "y")]
