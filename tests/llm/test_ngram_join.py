"""The n-gram join against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import pytest

from orderloom.llm import ngram_join
from orderloom.llm.ngram_join import keep_one_of_each, near_duplicates


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1))


def brute(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((str(i), len(s), str(None if i is None else find(i))) for i, s in sets)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for base in range(40):
        words = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 120, 400]))
        if base % 3 == 0:
            words = words + passage
        if base % 7 == 0:
            words = passage + words[:15]
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            own = list(words)
            for _ in range(rng.choice([0, 1, 2, len(own) // 25, len(own) // 18])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary + ["É", "NEW"])
            rows.append(own)
    rng.shuffle(rows)
    out = [(i * 2 + 1, rng.choice([" ", "\n", "  "]).join(w).upper() if i % 5 == 0 else " ".join(w))
           for i, w in enumerate(rows)]
    return out + [(0, None), (2, ""), (4, " \n "), (6, "one"), (8, "ONE"), (8, "ONE"), (None, "one"), (10, "x\xa0y"),
                  (12, "x y"), (14, "same " * 40_000), (16, "same " * 30_000)]


@pytest.mark.parametrize("seed,small", [(1, 8), (2, 2), (3, 2)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, small):
    monkeypatch.setattr(ngram_join, "SMALL_RUN", small)
    monkeypatch.setattr(ngram_join, "REPORT_FROM", 2)
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 3)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 10 * small)
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS", 5)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, a string, n int")
    got = near_duplicates(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(3, text, "a"), (1, text + " end", "b"), (2, "other words altogether", "c"), (5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == [1, 2, 5]
    assert keep_one_of_each(docs).columns == docs.columns


def test_no_documents(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
