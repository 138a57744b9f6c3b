from __future__ import annotations

import zlib

import numpy as np
import pytest

from helpers import documents, prose
from snapharbor.llm import quality, toxicity
from snapharbor.llm.labelled import training_rows

LABELS = "doc_id bigint, quality int, toxic int, text string"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    """Toxic texts have one of a few words among clean ones; bad ones shout or repeat themselves."""
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for k in range(900):
        w = prose(rng, int(rng.integers(5, 120))).split()
        toxic, good = k % 6 == 0, k % 7 != 0
        if toxic:
            for at in rng.integers(0, len(w), 2):
                w[at] = f"vile{k % 3}"
        if not good:
            w = [f"{x.upper()}!!" for x in w] if k % 2 else [x for x in w for _ in range(3)]
        rows.append((k, " ".join(w)))
        labels.append((k, int(good), int(toxic), "x"))
    odd = [(2000, None), (2001, ""), (2002, " \n"), (None, "no id"), (3, "a second text of id 3"), (2003, "vile1"), (2004, prose(rng, 20000))]
    labels += [(3, None, None, "x"), (5, 0, 0, "x"), (5, 1, 1, "x"), (None, 1, 1, "x"), (9999, 1, 1, "x")]
    return rows + odd, labels


def accuracy(rows, labels, k):
    truth = {x[0]: x[k] for x in labels if x[k] is not None}
    out = [r for r in rows if r.held_out and r.doc_id in truth]
    return np.mean([r.predicted == truth[r.doc_id] for r in out]), out


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_scores(spark, corpus, name):
    rows, labels = corpus
    score = toxicity.toxicity_scores if name == "toxic" else quality.quality_scores
    docs, marks = documents(spark, rows, clashing=True), spark.createDataFrame(labels, LABELS)
    out = score(docs, marks).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    assert all(r.held_out == held(r.doc_id) for r in out)
    line = 0.5 if name == "toxic" else 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= line) for r in out)
    right, tested = accuracy(out, labels, 2 if name == "toxic" else 1)
    assert len(tested) > 100 and right > 0.95
    blank = {r.score for r in out if r.doc_id in (2000, 2001)}
    assert len(blank) == 1
    again = score(docs, marks).collect()
    assert sorted((str(r.doc_id), r.score) for r in out) == sorted((str(r.doc_id), r.score) for r in again)


def test_held_out_labels_are_never_read(spark, corpus):
    rows, labels = corpus
    flipped = [(i, 1 - q if held(i) and q is not None else q, t, x) for i, q, t, x in labels]
    docs = documents(spark, rows[:300])
    a = quality.quality_scores(docs, spark.createDataFrame(labels, LABELS)).collect()
    b = quality.quality_scores(docs, spark.createDataFrame(flipped, LABELS)).collect()
    assert [r.score for r in a] == [r.score for r in b]


def test_sample_is_bounded_and_labels_resolved(spark, corpus):
    rows, labels = corpus
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    got = training_rows(docs, marks, "toxic", 50).collect()
    assert len({r.id for r in got}) == 50 and not any(held(r.id) for r in got)
    all_rows = {r.id: r.y for r in training_rows(docs, marks, "toxic").collect()}
    assert all_rows.get(5, 1) == 1 and None not in all_rows and 9999 not in all_rows


def test_an_id_of_many_rows_is_one_row_of_the_sample(spark):
    ids = [k for k in range(40) if not held(k)][:3]
    rows = [(ids[0], f"text {k}") for k in range(500)] + [(ids[1], None), (ids[1], "b"), (ids[2], None)]
    marks = spark.createDataFrame([(i, 1, 1, "x") for i in ids], LABELS)
    found = [training_rows(documents(spark, some), marks, "toxic").collect() for some in (rows, rows[::-1])]
    assert sorted(r.id for r in found[0]) == sorted(ids)
    assert {(r.id, r.text) for r in found[0]} == {(r.id, r.text) for r in found[1]}
    assert (ids[1], "b") in {(r.id, r.text) for r in found[0]}
    assert len(training_rows(documents(spark, rows), marks, "toxic", 1).collect()) == 1


def test_weights_are_sparse(spark, corpus):
    rows, labels = corpus
    at, weight = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert 0 < len(at) < 2000 and np.isfinite(weight).all()


@pytest.mark.parametrize("score", [toxicity.toxicity_scores, quality.quality_scores])
def test_no_labels_and_no_documents(spark, corpus, score):
    none = spark.createDataFrame([], LABELS)
    out = score(documents(spark, corpus[0][:5]), none).collect()
    assert [r.score for r in out] == [0.5] * 5
    assert score(documents(spark, []), none).collect() == []
    one_class = spark.createDataFrame([(k, 1, 1, "x") for k in range(5)], LABELS)
    assert all(np.isfinite(r.score) for r in score(documents(spark, corpus[0][:20]), one_class).collect())


def test_good_rows_stay_whole(spark, corpus):
    rows, labels = corpus
    docs = documents(spark, rows, clashing=True)
    trained = quality.train(docs, spark.createDataFrame(labels, LABELS))
    kept = quality.keep_good(docs, trained)
    good = [r.doc_id for r in quality.score_texts(docs, trained).collect() if r.predicted]
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, good))
