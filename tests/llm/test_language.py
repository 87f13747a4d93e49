"""The language model: probabilities against sums over all label sequences, held-out accuracy, odd texts."""

from __future__ import annotations

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm.language import FEATURES, features_of, fit, forward_backward, identify, keep_identified, time_major, \
    words_of

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_probabilities_are_those_of_all_sequences():
    rng = np.random.default_rng(0)
    counts, k = np.array([3, 0, 5, 1]), 3
    scores, transitions = rng.normal(size=(counts.sum(), k)), rng.normal(size=(k, k))
    place, begins = time_major(counts)
    ordered = np.empty_like(scores)
    ordered[place] = scores
    pairs = np.zeros((k, k))
    got = forward_backward(ordered, begins, transitions, pairs)[place]
    want_pairs, at = np.zeros((k, k)), 0
    for n in counts:
        want, total, steps = np.zeros((n, k)), 0.0, np.zeros((k, k))
        for tags in itertools.product(range(k), repeat=int(n)):
            links = list(zip(tags, tags[1:]))
            weight = np.exp(sum(scores[at + i, t] for i, t in enumerate(tags)) + sum(transitions[s] for s in links))
            total += weight
            for i, t in enumerate(tags):
                want[i, t] += weight
            for s in links:
                steps[s] += weight
        if n:
            assert np.allclose(got[at:at + n], want / total)
            want_pairs += steps / total
        at += n
    assert np.allclose(pairs, want_pairs)


def test_nothing_to_learn_from(spark):
    assert fit([]) is None
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(docs).collect()] == [("und", 0.0)] * 2
    assert identify(docs.limit(0)).count() == 0


def test_words_are_those_of_split():
    texts = ["a b", "", "  x\ty\x1cz ", "é\xa0ü", "日本\u3000語 b", "\x85", "one\u2028two", "no break", "tab\x0b\x0cend"] * 3
    words, places, counts = words_of(texts)
    flat = [words[i] for i in places]
    assert flat == [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]


def test_features_know_affixes_grams_and_lists():
    flat, counts, letters = features_of(["Kato", "kato", "12", "k1a"], {"kato": 5})
    assert letters.tolist() == [4, 4, 0, 2] and counts[2] == 0
    own = np.split(flat, np.cumsum(counts)[:-1])
    # itself, three affixes on either side, five bigrams, four trigrams, and two languages whose lists hold it
    assert counts.tolist()[:2] == [18, 18] and own[0].tolist() == own[1].tolist()
    assert own[0][-2:].tolist() == [FEATURES, FEATURES + 2]
    assert counts[3] == 1 + 4 + 3 + 2  # two letters: affixes of one and two, three bigrams, two trigrams


def test_single_precision_gives_the_same_labels():
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 400, 300)
    scores, transitions = rng.normal(size=(counts.sum(), 4)) * 3, rng.normal(size=(4, 4)) * 2
    place, begins = time_major(counts)
    ordered = np.empty_like(scores)
    ordered[place] = scores
    exact = forward_backward(ordered, begins, transitions)
    single = forward_backward(ordered.astype(np.float32), begins, transitions)
    assert np.abs(exact - single).max() < 1e-4
    clear = np.sort(exact, axis=1)[:, -1] - np.sort(exact, axis=1)[:, -2] > 1e-3
    assert (exact.argmax(1) == single.argmax(1))[clear].all()


def rows():
    words = {"xx": ["kato", "mikato", "tokami", "nakitu"], "yy": ["straugh", "brelds", "schwolm", "frints"]}
    out = []
    for i in range(120):
        lang = ("xx", "yy")[i % 2]
        out.append((i, " ".join(words[lang][(i * j) % 4] for j in range(12)), lang if i % 7 else None, "a"))
    return out


def test_mixed_and_odd_texts(spark):
    odd = [(500, None, "xx", "a"), (501, "", "yy", "a"), (502, "123 ... !!", "xx", "a"), (None, "kato mikato", "xx", "a"),
           (503, "kato " * 50_000, None, "a"), (504, "kato tokami mikato " * 10 + "brelds frints schwolm " * 30, None, "a"),
           (505, "frints", None, "a"), (505, "frints", None, "a")]
    docs = spark.createDataFrame(rows() + odd, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert len(got) == 127 and identify(docs).count() == 128
    for i, _, lang, _ in rows():
        assert got[i].lang_pred == ("xx", "yy")[i % 2] and got[i].score > 0.9
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert got[None].lang_pred == "xx" and got[None].held_out is False
    assert got[503].lang_pred == "xx" and got[504].lang_pred == "yy" and 0.6 < got[504].score < 0.9
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows()} | {503, 504, 505, None}


@pytest.mark.skipif(not os.path.exists(DATA), reason="the provided data is not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
