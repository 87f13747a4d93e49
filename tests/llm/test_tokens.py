"""Token files and packing against the tokenizers library used directly."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm.common import new_folder
from orderloom.llm.packing import pack
from orderloom.llm.token_files import token_round_trip
from orderloom.llm.tokens import PieceEncoder

BITS = ["a", "b", " ", "\n", "\t", "é", "é", "'s", "1", "!!", "\x1c", "\x01", "İ", "Σ", "word.",
        "<|endoftext|>", "  ", "", " ", "\r\n", "日本", " ́", "Ünder,", " "]
FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


def texts(n=400):
    rng = random.Random(3)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 30))) for _ in range(n)] + ["", " ", "x " * 30_000]


def direct(name, values):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(values, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,spaced", FILES)
def test_pieces_give_the_ids_of_the_whole_text(name, spaced):
    values = texts(3000)
    flat, n = PieceEncoder(public_tokenizers.path(name), spaced).encode(values, 7)
    want = [w + [7] for w in direct(name, values)]
    assert n.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def frame(spark, values):
    rows = [(i * 3 - 5, t, "x") for i, t in enumerate(values)] + [(1, None, "y"), (1, None, "y"), (None, "null id", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5), rows


def test_files_hold_every_document_in_id_order(spark):
    docs, rows = frame(spark, texts())
    got = token_round_trip(docs, new_folder(spark, "test"), public_tokenizers.path(FILES[0][0]), False, 2).collect()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [w + [2] for w in direct(FILES[0][0], [r[1] or "" for r in rows])]
    starts = np.cumsum([0] + [len(w) for w in ids]).tolist()
    want = [(r[0], s, len(w), crc(w)) for r, s, w in zip(rows, starts, ids)]
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_pieces_tile_windows_and_documents(spark):
    docs, rows = frame(spark, texts())
    window = 64
    got = pack(docs, public_tokenizers.path(FILES[1][0]), True, 0, window).collect()
    ids = [w + [0] for w in direct(FILES[1][0], [r[1] or "" for r in rows])]
    total = sum(map(len, ids))
    by_window = {}
    for r in got:
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k in range(len(by_window)):
        spans = sorted(by_window[k])
        ends = [a + n for a, n in spans]
        assert [a for a, _ in spans] == [0] + ends[:-1]
        assert ends[-1] == (window if k < len(by_window) - 1 else total - window * k)
    want = {}
    for (doc, *_), w in zip(rows, ids):
        want.setdefault(doc, []).append(w)
    for doc, lists in want.items():
        own = [r for r in got if r.doc_id == doc]
        assert sum(r.length for r in own) == sum(map(len, lists))
        for r in own:
            assert any(len(w) == r.doc_tokens and crc(w[r.start:r.start + r.length]) == r.ids_crc32 for w in lists)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = public_tokenizers.path(FILES[0][0])
    assert token_round_trip(docs, new_folder(spark, "test"), path, False, 2).count() == 0
    assert pack(docs, path, False, 0).count() == 0
