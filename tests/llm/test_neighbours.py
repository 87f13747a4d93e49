"""Nearest neighbours against brute force: recall, exact scores, and odd rows."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import neighbours
from orderloom.llm.neighbours import hadamard, nearest


def brute(rows, is_query, k):
    clean = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        clean.setdefault(i, []).append(np.array(v, np.float64))
    out = {}
    for q in (i for i in clean if is_query(i)):
        scored = {i: max(float(a @ b) for a in clean[q] for b in vs if len(a) == len(b)) for i, vs in clean.items()
                  if i != q and any(len(a) == len(b) for a in clean[q] for b in vs)}
        out[q] = sorted(((-s, i) for i, s in scored.items()))[:k]
    return out


def recall(spark, rows, k=20, kind="float", **options):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    got = {}
    for r in nearest(frame.withColumn("score", F.lit("x")), F.col("vec_id") % 20 == 0, k, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, lambda i: i % 20 == 0, k)
    assert set(got) == {q for q, hits in want.items() if hits}
    found = total = 0
    vectors = {i: np.array(v, np.float64) for i, v in rows if v is not None and i is not None and None not in v}
    for q, hits in want.items():
        own = sorted(got.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(hits) + 1))
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        for _, i, s in own:
            assert s == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-12)
        found += len({i for _, i, _ in own} & {i for _, i in hits})
        total += len(hits)
    return found / max(total, 1)


def test_turns_keep_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def test_recall_on_unit_vectors_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 300)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[:1000] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    assert recall(spark, rows) >= 0.9


def test_lengths_differ(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 24)) * rng.lognormal(size=(6000, 1), sigma=0.3)
    assert recall(spark, [(i, v.tolist()) for i, v in enumerate(x)], kind="double") >= 0.9


def test_odd_rows_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]),
            (9, [0.5, 0.5]), (9, [0.5, 0.5]), (60, [1.0, 0.0, 0.0])]
    assert recall(spark, rows) == 1.0


@pytest.mark.parametrize("kind,chunk", [("equal", 20_000), ("twice", 20_000), ("different", 25)])
def test_copies_of_an_id_take_one_place(spark, monkeypatch, kind, chunk):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    rng = np.random.default_rng(3)

    def near(n, noise, of):
        x = of + noise * rng.normal(size=(n, 32))
        return (x / np.linalg.norm(x, axis=1, keepdims=True)).tolist()

    base = rng.normal(size=32)
    base /= np.linalg.norm(base)
    rows = list(enumerate(near(20, 0.001, base)))
    if kind == "twice":
        rows += rows
    else:
        rows += [(1, v) for v in 60 * [rows[0][1]]] if kind == "equal" else [(1, v) for v in near(60, 1e-5, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(frame, F.col("vec_id") == 0, 10).collect())
    want = brute(rows, lambda i: i == 0, 10)[0]
    assert [i for _, i, _ in got] == [i for _, i in want]
    assert [s for _, _, s in got] == pytest.approx([-s for s, _ in want], abs=1e-12)


def test_no_vectors(spark):
    assert recall(spark, []) == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="the provided data is not here")
def test_recall_on_the_provided_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    assert recall(spark, rows) >= 0.9
