"""The line field against enumeration of all labellings, on odd rows, and on held-out documents."""

import itertools
import zlib

import numpy as np
import pyarrow as pa

import __spark_entry__ as contract
from orderlens.llm import line_quality as Q
from orderlens.llm.common import prepare, utf8

SCHEMA = "doc_id long, text string, score double, bad int, features string"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 2, 7, 1]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    unary, pairs = rng.normal(0, 3, firsts[-1]), rng.normal(0, 1.5, (2, 2))
    bad, joint, total = Q.marginals(unary, firsts, pairs)
    logs = 0.0
    for a, b in zip(firsts, firsts[1:]):
        weight, of_line, of_pair = 0.0, np.zeros(b - a), np.zeros((b - a, 2, 2))
        for labels in itertools.product((0, 1), repeat=b - a):
            odds = sum((l - 0.5) * u for l, u in zip(labels, unary[a:b])) + sum(pairs[i, j] for i, j in zip(labels, labels[1:]))
            p = np.exp(odds)
            weight += p
            of_line += p * np.array(labels)
            for t, (i, j) in enumerate(zip(labels, labels[1:])):
                of_pair[t, i, j] += p
        logs += np.log(weight)
        assert np.allclose(bad[a:b], of_line / weight)
        assert np.allclose(joint[a : b - 1], of_pair[:-1] / weight)
    assert np.isclose(total, logs)


def test_long_and_certain_chains_stay_finite():
    unary = np.tile([200.0, -200.0], 50_000)
    bad, _, total = Q.marginals(unary, np.array([0, 100_000]), np.array([[3.0, -3.0], [-3.0, 3.0]]))
    assert np.isfinite(total) and bad[0] > 0.99 and bad[1] < 0.01


def test_lines_and_neighbours():
    texts = ["", "a\n\nBb cc cc!", None, "\n", "é|é"]
    data, offsets = utf8(pa.array(texts))
    starts, ends, firsts = Q.lines_of(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == [x for t in texts for x in (t or "").split("\n")]
    assert firsts.tolist() == [0, 1, 4, 5, 7, 8]
    rows, _ = Q.features(data, offsets)
    for i in range(len(found)):
        alone = Q.features(*utf8(pa.array([found[i]])))[0][0, : Q.OWN]
        assert np.allclose(rows[i, : Q.OWN], alone)
        before = np.zeros(Q.OWN) if i in firsts else rows[i - 1, : Q.OWN]
        after = np.zeros(Q.OWN) if i + 1 in firsts else rows[i + 1, : Q.OWN]
        assert np.allclose(rows[i, Q.OWN : 2 * Q.OWN], before) and np.allclose(rows[i, 2 * Q.OWN : 3 * Q.OWN], after)
    assert np.isclose(rows[3, 2 * Q._KINDS + 3], 0.0) and np.isclose(rows[3, 2 * Q._KINDS + 4], 1.0)


def test_odds_equal_the_features_whatever_the_slab(monkeypatch):
    rng = np.random.default_rng(1)
    field = Q.Field(rng.normal(size=Q.FEATURES), rng.uniform(1, 2, Q.FEATURES), rng.normal(size=Q.FEATURES), np.zeros((2, 2)))
    data, offsets = utf8(pa.array(["a\n\nBb | cc cc!", "", "x\ny z. \n"]))
    rows, firsts = Q.features(data, offsets)
    want = ((rows - field.center) / field.scale) @ field.weights
    for slab in (1, 3, 1000):
        monkeypatch.setattr(Q, "SLAB", slab)
        assert np.allclose(field.unary(data, *Q.lines_of(data, offsets)), want, atol=1e-4)


def test_score_is_length_weighted():
    """The share of the score that a line has is its length with its break."""
    field = Q.Field(np.zeros(Q.FEATURES), np.ones(Q.FEATURES), np.zeros(Q.FEATURES), np.zeros((2, 2)))
    field.weights[list(Q._CLASSES).index("bar")] = 40.0  # a line of bars is bad, neighbours say nothing
    field.weights[-1] = -20.0
    got = Q.scores_of(field, pa.array(["abcdefghi\n||||", "||||", "", None]))
    assert np.allclose(got, [10 / 15, 0, 1, 1], atol=1e-6)


def test_held_out_documents(spark):
    """At least 95 of 100 held-out labels are met, and good documents are kept."""
    folder = "/root/testdata/sf0.01"
    found = contract.queries()["op13_quality"](spark, folder).toPandas()
    given = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").toPandas()
    assert sorted(found.doc_id) == sorted(given.doc_id)
    assert list(found.held_out) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    rows = found.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    rows = rows[rows.held_out]
    assert (rows.predicted == rows.quality).mean() >= 0.95
    assert (rows[rows.quality == 1].predicted == 1).mean() >= 0.98


def test_labels_of_held_out_rows_change_nothing(spark):
    folder = "/root/testdata/sf0.001"
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = Q.held_out(labels.doc_id)
    turned = labels.selectExpr("doc_id", "1 - quality AS quality", "toxic").where(held).union(labels.where(~held))
    a, b = (Q.quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeats, several labels, clashing names, no rows, no labels."""
    prepare(spark)
    good, bad = "The text of a line.\nIt goes on and on, as texts do.", "|| || ||\nA A A A A A A ## ##"
    rows = [(i, good if i % 3 else bad) for i in range(60)] + [(None, good), (None, None), (61, None), (62, "")]
    rows += [(63, "\n" * 30_000), (64, good * 3000), (65, "word " * 200_000), (1, good)]
    docs = spark.createDataFrame([(*r, 2.0, 5, "f") for r in rows], SCHEMA)
    marks = [(i, int(i % 3 > 0)) for i in range(60)] + [(1, 1), (3, None), (None, 1), (62, 1), (64, 1)]
    labels = spark.createDataFrame([(*m, 0, 1) for m in marks], "doc_id long, quality int, toxic int, bad int")
    found = Q.quality_scores(docs, labels).collect()
    assert len(found) == len(rows)
    kept = {r.doc_id: r.predicted for r in found if r.doc_id is not None and r.doc_id < 60}
    assert kept == {i: int(i % 3 > 0) for i in range(60)}
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert Q.quality_scores(docs.limit(0), labels).collect() == []
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    one = Q.quality_scores(docs, labels.where("quality = 1"), most_lines=20).collect()
    assert all(r.predicted == 1 for r in one if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 3)
