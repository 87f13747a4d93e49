"""Repeated passages against a walk over all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from orderloom.llm import substring_dedup
from orderloom.llm.substring_dedup import drop_repeats


def brute(rows, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    first = {}
    for i, words in split:
        if i is not None:
            for s in range(len(words) - window + 1):
                key = tuple(words[s:s + window])
                first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, words in split:
        gone = set()
        if i is not None:
            for s in range(len(words) - window + 1):
                if first[tuple(words[s:s + window])] != (i, s):
                    gone.update(range(s, s + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "\xa0", "\x1c", "日本"]
    passages = [rng.choices(vocabulary, k=rng.choice([19, 20, 21, 40, 90])) for _ in range(8)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choices(vocabulary, k=rng.choice([0, 3, 40]))
            passage = rng.choice(passages)
            a = rng.randrange(len(passage)) if rng.random() < 0.3 else 0
            words += passage[a:]
        rows.append((rng.randrange(10 ** 6) * 1000 + i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(7, None), (8, ""), (9, " "), (None, " ".join(passages[4] * 3)), (10, "a b c"), (11, "same " * 30_000),
             (12, "one two three " * 2_000), (13, " ".join(passages[4])), (13, " ".join(passages[4]))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,flush", [(1, 4_000_000), (2, 300)])
def test_words_that_go_are_those_of_the_walk(spark, monkeypatch, seed, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH_WORDS", flush)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, found int").repartition(4)
    got = drop_repeats(docs, 20).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == brute(rows, 20)


def test_texts_and_spans(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, "new " + text + " end")], "doc_id long, text string")
    got = {r.doc_id: r for r in drop_repeats(docs, 20, with_text=True).collect()}
    assert got[1].kept_text == text and got[1].spans == []
    assert got[2].kept_text == "new end" and [tuple(s) for s in got[2].spans] == [(1, 30)]


def test_no_documents(spark):
    assert drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    own = " ".join(f"u{i}" for i in range(60))
    fresh = " ".join(f"n{i}" for i in range(200))
    cases = [[(0, passage), (1, f"{fresh} {passage}"), (1, "short")],
             [(0, passage), (1, passage + " and five more words here"), (1, own)]]
    for rows in cases:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        got = {(r.doc_id, r.n_words): r.n_removed for r in drop_repeats(docs).collect()}
        assert got[(1, len(rows[1][1].split()))] == 40
        assert got[(0, 40)] == 0 and got[(1, len(rows[2][1].split()))] == 0


def test_words_made_to_collide_are_different(spark):
    def thue_morse(first):
        word = first
        while len(word) < 1024:
            word += word.translate(str.maketrans("ab", "ba"))
        return word

    words = [[thue_morse(first) + str(i) for i in range(24)] for first in "ab"]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    assert [r.n_removed for r in drop_repeats(docs).collect()] == [0, 0]
