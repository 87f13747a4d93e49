"""Ranked search against its definition, term by term."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

import orderloom.llm.ranked_search as ranked
from orderloom.llm.ranked_search import search_ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        scored = []
        for doc, counts in held:
            m = 50 + (50 * sum(counts.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * counts[t] // (1000 * counts[t] + 20 * m)) for t in wanted if t in counts)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        rows += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(3),
            spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"))


@pytest.mark.parametrize("shard_bytes,block,k", [(8_000_000, 128, 50), (3_000, 4, 5), (20_000, 16, 1)])
def test_ranks_are_those_of_the_definition(spark, monkeypatch, shard_bytes, block, k):
    monkeypatch.setattr(ranked, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(ranked, "BLOCK", block)
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "x_y", "日本", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(600)]
    docs += [(7, docs[7][1]), (None, docs[9][1]), (None, None), (700, None), (701, "..."), (702, "w1 " * 70_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(25)]
    items += [(3, "w1 w2"), (None, "w5 W5 w290"), (90, None), (91, "nowhere"), (92, "")]
    got = search_ranked(*frames(spark, docs, items), k=k)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, k)


def test_passes_change_nothing(spark, monkeypatch):
    docs = [(i, f"a b{i % 7} c{i % 3}") for i in range(100)]
    items = [(i, f"b{i % 7} c1 a") for i in range(9)]
    want = plain(docs, items, 5)
    monkeypatch.setattr(ranked, "PASS_TERMS", 6)
    assert sorted(map(tuple, search_ranked(*frames(spark, docs, items), k=5).collect()), key=str) == want


def test_empty_sides(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a")])
    assert search_ranked(docs.limit(0), items).count() == 0
    assert search_ranked(docs, items.limit(0)).count() == 0
