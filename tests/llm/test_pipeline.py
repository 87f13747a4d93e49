"""The pipeline against a plain version of its stages, and the small operators behind it."""

from __future__ import annotations

import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import common
from orderloom.llm.common import attach_groups
from orderloom.llm.exact_dedup import drop_copies, exact_groups
from orderloom.llm.language import identify
from orderloom.llm.ngram_join import keep_one_of_each
from orderloom.llm.language import keep_identified
from orderloom.llm.mixing import mix, source_rates
from tests.llm.test_ngram_join import brute

DATA = "/root/testdata/sf0.001"


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2 ** 52


def copies(rate, at):
    p = total = math.exp(-rate)
    n = 0
    while at >= total and n < rate + 60:
        n += 1
        p *= rate / n
        total += p
    return n


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the provided data is not here")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    tags = {r.doc_id: r for r in identify(docs).collect()}
    rows = [r for r in docs.collect() if tags[r.doc_id].lang_pred != "und" and tags[r.doc_id].score >= 0.4]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r)
    rows = list(first.values())
    label = {i: c for i, _, c in brute([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if label[str(r.doc_id)] == str(r.doc_id)]
    mass = Counter()
    for r in rows:
        mass[r.source] += len(r.text or "") + 1
    total, weights = sum(mass.values()), {s: math.sqrt(m) for s, m in mass.items()}
    rates = {s: total * weights[s] / sum(weights.values()) / m for s, m in mass.items()}
    want = Counter({r.doc_id: copies(rates[r.source], uniform("mix", r.doc_id)) for r in rows})
    want = Counter({i: n for i, n in want.items() if n})
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == want
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    tokenizer.encode_special_tokens = True
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in rows if want[r.doc_id]}
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start:r.start + r.length], "<u4").tobytes())
    tokens = sum(len(ids[i]) * n for i, n in want.items())
    assert sum(r.length for r in got) == tokens
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert len(filled) == -(-tokens // 1024) and sorted(filled.values())[1:] == [1024] * (len(filled) - 1)


def test_stages_keep_the_columns(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, "").dtypes == empty.dtypes
        assert stage(spark, empty, "").count() == 0


@pytest.mark.parametrize("keep,choose", [("smallest", min), ("largest", max)])
def test_exact_groups(spark, keep, choose):
    long = "x" * 500_000
    rows = [(5, "a"), (3, "a"), (9, "A"), (1, None), (2, ""), (7, long), (8, long + "y"), (6, long), (4, " a"),
            (11, "é"), (12, "é"), (3, "a"), (None, "a"), (None, "alone")] + [(100 + i, "hot") for i in range(50)]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in rows],
                                 "doc_id long, text string, keep_id int, kept string").repartition(4)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = sorted((str(i), str(choose([x for x in groups[t or ""] if x is not None], default=None)),
                   len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    got = exact_groups(docs, keep).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.keep_id) for r in got)
    left = drop_copies(docs, keep)
    assert left.columns == docs.columns
    kept = {r.doc_id for r in got if r.kept}
    assert {r.doc_id for r in left.collect()} == kept | {None}  # of a text that only null ids have, one row stays
    assert [r.text for r in left.filter("doc_id is null").collect()] == ["alone"]
    assert exact_groups(docs.limit(0)).count() == 0


def test_groups_meet_hot_and_cold(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 4)
    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 5}") for i in range(40)] + [(99, "none")],
                                 "id long, k string")
    groups = rows.filter("k <> 'none'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = {r.id: (r.n, r.top) for r in attach_groups(rows, groups, "k", "n", "id").collect()}
    want = {r.k: (r.n, r.top) for r in groups.collect()}
    assert got == {r.id: want.get(r.k, (None, None)) for r in rows.collect()}


def frame(spark):
    rows = [(i, "word " * (i % 50), "big" if i % 3 else f"s{i % 4}", "x") for i in range(3000)]
    rows += [(5000, None, None, "x"), (5001, "abc", None, "x"), (None, "null id", "s1", "x"), (7, "twice", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _copies string")
    return docs.withColumns({"cdf": F.lit(0), "rate": F.lit("r"), "_id": F.lit(1), "_salt": F.lit(2)}), rows


def test_copies_follow_the_rates(spark):
    docs, rows = frame(spark)
    got = mix(docs, seed="t").collect()
    rates = {r.source: r.rate for r in source_rates(docs).collect()}
    per_row = Counter((r.doc_id, r.source, r.text) for r in got)
    for i, text, source, _ in rows:
        at = uniform("t", "" if i is None else i)
        assert per_row[(i, source, text)] == copies(rates[source], at)
    keys = [r["_shuffle"] for r in got]
    assert keys == sorted(keys) and mix(docs, seed="t").collect() == got
    mass, target = Counter(), Counter()
    for _, text, source, _ in rows:
        target[source] += len(text or "") + 1
    for r in got:
        mass[r.source] += len(r.text or "") + 1
    goal = {s: math.sqrt(m) for s, m in target.items()}
    for s in ("big", "s1"):
        assert mass[s] / sum(mass.values()) == pytest.approx(goal[s] / sum(goal.values()), rel=0.1)


def test_given_weights_and_large_rates(spark):
    docs, rows = frame(spark)
    got = mix(docs, {"s1": 1.0, None: 1.0}, shuffle=False)
    found = {r.source: r.n for r in got.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = {r.source: r.rate for r in source_rates(docs, {"s1": 1.0, None: 1.0}).collect()}
    assert set(found) == {"s1", None} and rates["big"] == 0 and rates[None] > 1000
    assert found[None] == pytest.approx(2 * rates[None], rel=0.1)
    assert mix(docs.limit(0)).count() == 0


def test_rows_with_null_ids_pass_every_stage(spark):
    words = " ".join(f"word{i}" for i in range(30))
    rows = [(None, f"{words} alone", "en", "s", 1), (None, f"{words} alone", "en", "s", 1), (None, None, None, "s", 0),
            (1, "an english text about things", "en", "s", 2), (2, "noch ein deutscher Text dazu", "de", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert drop_copies(docs.filter("text is not null")).filter("doc_id is null").count() == 1
    assert keep_one_of_each(docs).filter("doc_id is null").count() == 3
    assert keep_identified(docs).filter("doc_id is null").count() == 2


def test_texts_under_one_id_are_judged_alone(spark):
    docs = spark.createDataFrame([(3, "a"), (5, "a"), (5, "b")], "doc_id long, text string")
    assert sorted(map(tuple, drop_copies(docs).collect())) == [(3, "a"), (5, "b")]
