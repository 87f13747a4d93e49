"""Merge rounds against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from orderloom.llm.queries import QUERIES
from orderloom.llm.sentence_pieces import MergeRounds, decode_ids, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "b", " ", "  ", "\n", "\t", "é", "ner", "ensors", "serve", "remot", "日本", "😀", "́", "▁", "İ", "n", "e", "r",
        "<0x0A>", "<s>", "</s>", "\x00", " " * 17, " " * 40, "ing", "\xa0"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(library):
    rng = random.Random(4)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    made = ["".join(rng.choices(BITS, k=rng.randint(0, 30))) for _ in range(1500)]
    made += ["".join(rng.choices(pieces, k=rng.randint(0, 20))) for _ in range(3000)]
    made += ["".join(rng.choices("nerstoi ", k=rng.randint(0, 200))) for _ in range(500)]
    for k in range(70):
        made += [" " * k, " " * k + "hello", "a" + " " * k + "😀"]
    return made + ["ner" * 3000, " " * 100_000, "a" * 3000, "", "x " * 50_000]


def test_ids_and_texts_are_those_of_the_library(library):
    values = texts(library)
    rounds = MergeRounds(PATH)
    flat, lengths = rounds.encode(values, 2)
    ends = np.cumsum(lengths)
    back = rounds.decode(flat, lengths)
    for value, a, b, decoded in zip(values, ends - lengths, ends, back):
        ids = flat[a:b].tolist()
        assert ids == library.encode(value, add_eos=True), repr(value[:80])
        assert decoded == library.decode(ids)
    flat, lengths = rounds.encode(["a b", ""], None)
    assert flat.tolist() == library.encode("a b") and lengths.tolist() == [len(flat), 0]


def test_decoding_of_any_ids(library):
    rng = random.Random(6)
    lists = [[rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 9))] for _ in range(800)]
    lists += [[2], [1, 2], [0], [1, 29871, 29871, 2]]
    got = MergeRounds(PATH).decode(np.array([i for x in lists for i in x]), np.array(list(map(len, lists))))
    assert got == [library.decode(x) for x in lists]


def test_every_row_of_a_table(spark, library):
    rows = [(i, t, "z") for i, t in enumerate(texts(library)[::40])] + [(1, None, "z"), (1, None, "z"), (None, "no id", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    encoded = encode_texts(docs, PATH, end=2, decoded=True)
    want = sorted(((d, library.encode(t or "", add_eos=True)) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == want
    back = decode_ids(encode_texts(docs, PATH, end=None), PATH).collect()
    assert sorted(((r.doc_id, r.decoded) for r in back), key=str) == sorted(
        ((d, library.decode(library.encode(t or ""))) for d, t, _ in rows), key=str)
    assert encode_texts(docs.limit(0), PATH, end=2).count() == 0


def test_query_gives_digests(spark, tmp_path, library):
    values = texts(library)[::60]
    spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op11_merge_rounds"](spark, str(tmp_path)).collect():
        ids = library.encode(values[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
