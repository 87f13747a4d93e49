"""Repeated passages by seed and extend.

Seeds: in every window of `window` words, the run of GRAM words with the least hash is an anchor (winnowing), so equal
windows have equal anchors at equal places. An index of anchors tells those that occur more than once; a window whose
anchor occurs once occurs once itself.
Extension: around an anchor that occurs again, every window that chose it is compared, one word further left or right
at a time, with those around the anchor's other occurrences. Neighbouring windows that match make up one span, so the
spans are the maximal repeats of at least `window` words, also where the repeats of one passage differ in length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged, text_or_empty
from orderloom.llm.words import byte_blocks, mixed, run_hashes, word_hashes

GRAM = 6
FLUSH_WORDS = 4_000_000  # words after which a task hands on what it has gathered
BUCKETS_PER_PARTITION = 4
# index entries of a bucket (keys and their owners) or, without keys, places that are found already
ROWS = "bucket long, keys binary, docs binary, signs binary, starts binary, counts binary"
FOUND = "bucket long, docs binary, signs binary, starts binary"


def anchors_of(words: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with ``counts`` words each, laid end to end: the hash of every run of GRAM words, the first words of
    all windows, and the place of each window's anchor. Of equal hashes the leftmost is the anchor."""
    grams = run_hashes(words, GRAM)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    starts = np.flatnonzero(left >= window)
    if not len(starts):
        return grams, starts, starts
    n = len(words) - window + 1
    best, place = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, window - GRAM + 1):
        lower = grams[i:n + i] < best
        np.copyto(best, grams[i:n + i], where=lower)
        place[lower] = i
    return grams, starts, starts + place[starts]


def _packed(bucket: np.ndarray, *columns: np.ndarray) -> tuple[list[int], list[list[bytes]]]:
    """Columns sorted by bucket, as one value of bytes per bucket."""
    edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    spans = list(zip(edges, edges[1:] + [len(bucket)]))
    return bucket[edges].tolist(), [[c[a:b].tobytes() for a, b in spans] for c in columns]


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _found_rows(docs: np.ndarray, signs: np.ndarray, places: np.ndarray, buckets: int) -> pd.DataFrame:
    """Places by bucket of their document."""
    bucket = _bucket_of(mixed(docs.view(np.uint64)), buckets)
    by = np.lexsort((places, signs, docs, bucket))
    names, (d, g, s) = _packed(bucket[by], docs[by], signs[by], places[by].astype(np.int32))
    return pd.DataFrame({"bucket": names, "docs": d, "signs": g, "starts": s})


def _joined(values: pd.Series, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(v, kind) for v in values)])


def _hashed(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, slice]]:
    """Blocks of texts: word hashes, words per text, ids and signs. A document is an id and the CRC-32 of a text, so that
    texts that share an id are not taken for one another."""
    raw = [t.encode() for t in batch["text"]]
    ids, signs = batch["doc_id"].to_numpy(np.int64), batch["sign"].to_numpy(np.int64).astype(np.uint32)
    for block in byte_blocks(raw):
        words, counts = word_hashes(raw[block])
        yield words, counts, ids[block], signs[block], block


def anchor_index(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """Index entries of every anchor. An anchor that a task meets twice is known to repeat: its places are found at
    once, and a single entry without owner (count 0) tells the other tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, parts = 0, []

        def flushed() -> Iterator[pd.DataFrame]:
            keys, owners, signs, places = (np.concatenate(x) for x in zip(*parts))
            by = np.argsort(keys, kind="stable")
            keys, owners, signs, places = keys[by], owners[by], signs[by], places[by]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            again = ~first | np.concatenate([~first[1:], [False]])
            if again.any():
                yield _found_rows(owners[again], signs[again], places[again], buckets).assign(keys=None, counts=None)
            keys, owners, signs, places, owned = keys[first], owners[first], signs[first], places[first], ~again[first]
            bucket = _bucket_of(keys, buckets)
            by = np.argsort(bucket, kind="stable")
            names, (k, d, g, s, c) = _packed(bucket[by], keys[by], owners[by], signs[by], places[by].astype(np.int32),
                                             owned[by].astype(np.int8))
            yield pd.DataFrame({"bucket": names, "keys": k, "docs": d, "signs": g, "starts": s, "counts": c})

        for batch in batches:
            for words, counts, ids, signs, _ in _hashed(batch):
                grams, _, anchor = anchors_of(words, counts, window)
                if len(anchor):
                    anchor = anchor[np.concatenate([[True], anchor[1:] != anchor[:-1]])]
                    ends = np.cumsum(counts)
                    owner = np.searchsorted(ends, anchor, side="right")
                    parts.append((grams[anchor], ids[owner], signs[owner], anchor - (ends - counts)[owner]))
                held += len(words)
                if held >= FLUSH_WORDS and parts:
                    yield from flushed()
                    held, parts = 0, []
        if parts:
            yield from flushed()

    return docs.mapInPandas(run, ROWS)


def repeated_anchors(index: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, found``: places of anchors that occur more than once."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known, entries = group[group["keys"].isna()], group[group["keys"].notna()]
        keys, owned = _joined(entries["keys"], np.uint64), _joined(entries["counts"], np.int8) > 0
        docs, starts = _joined(entries["docs"], np.int64), _joined(entries["starts"], np.int32)
        signs = _joined(entries["signs"], np.uint32)
        by = np.argsort(keys, kind="stable")
        keys, docs, signs, starts, owned = keys[by], docs[by], signs[by], starts[by], owned[by]
        same = keys[1:] == keys[:-1]
        live = np.zeros(len(keys), bool)
        live[1:] |= same
        live[:-1] |= same
        live &= owned
        return _found_rows(np.concatenate([docs[live], _joined(known["docs"], np.int64)]),
                           np.concatenate([signs[live], _joined(known["signs"], np.uint32)]),
                           np.concatenate([starts[live], _joined(known["starts"], np.int32)]), buckets)

    return _by_document(index.groupBy("bucket").applyInPandas(run, FOUND))


def _by_document(found: DataFrame) -> DataFrame:
    """One row per document: its places in order, as 32-bit numbers."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        docs, places = _joined(group["docs"], np.int64), _joined(group["starts"], np.int32)
        signs = _joined(group["signs"], np.uint32)
        by = np.lexsort((places, signs, docs))
        docs, signs, places = docs[by], signs[by], places[by]
        edges = np.flatnonzero(np.concatenate(
            [[True], (docs[1:] != docs[:-1]) | (signs[1:] != signs[:-1])])[:len(docs)]).tolist()
        return pd.DataFrame({"doc_id": docs[edges], "sign": signs[edges].astype(np.int64), "found": [
            places[a:b].tobytes() for a, b in zip(edges, edges[1:] + [len(docs)])]})

    return found.groupBy("bucket").applyInPandas(run, "doc_id long, sign long, found binary")


def window_index(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """Index entries of the windows around anchors that repeat; the windows of one anchor share an entry and a
    bucket. Of equal windows of one task only the earliest needs an entry; the others are found to repeat."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, parts = 0, []

        def flushed() -> Iterator[pd.DataFrame]:
            keys, hashes, owners, signs, starts = (np.concatenate(x) for x in zip(*parts))
            by = np.lexsort((starts, signs, owners, hashes))
            keys, hashes, owners, signs, starts = keys[by], hashes[by], owners[by], signs[by], starts[by]
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            later = (owners != owners[head]) | (signs != signs[head]) | (starts != starts[head])
            if later.any():
                yield _found_rows(owners[later], signs[later], starts[later], buckets).assign(keys=None, counts=None)
            keys, hashes, owners, signs, starts = keys[first], hashes[first], owners[first], signs[first], starts[first]
            bucket = _bucket_of(keys, buckets)
            by = np.lexsort((starts, signs, owners, bucket))
            bucket, hashes, owners, signs, starts = bucket[by], hashes[by], owners[by], signs[by], starts[by]
            # windows side by side in one bucket are kept as the first one and their number
            new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owners[1:] != owners[:-1])
                                  | (signs[1:] != signs[:-1]) | (starts[1:] != starts[:-1] + 1)])
            at = np.flatnonzero(new)
            size = np.diff(at, append=len(new)).astype(np.int32)
            names, (k,) = _packed(bucket, hashes)
            _, (d, g, s, c) = _packed(bucket[at], owners[at], signs[at], starts[at].astype(np.int32), size)
            yield pd.DataFrame({"bucket": names, "keys": k, "docs": d, "signs": g, "starts": s, "counts": c})

        for batch in batches:
            found = batch["found"].tolist()
            for words, counts, ids, signs, block in _hashed(batch):
                grams, starts, anchor = anchors_of(words, counts, window)
                ends = np.cumsum(counts)
                begins = ends - counts
                live = np.zeros(len(words), bool)
                for base, places in zip(begins.tolist(), found[block]):
                    live[base + np.frombuffer(places, np.int32)] = True
                chosen = live[anchor]
                starts, anchor = starts[chosen], anchor[chosen]
                owner = np.searchsorted(ends, starts, side="right")
                parts.append((grams[anchor], run_hashes(words, window)[starts], ids[owner], signs[owner],
                              starts - begins[owner]))
                held += len(starts)
                if held >= FLUSH_WORDS // 4:
                    yield from flushed()
                    held, parts = 0, []
        if held:
            yield from flushed()

    return docs.mapInPandas(run, ROWS)


def later_windows(index: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, found``: first words of windows that also start earlier."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known, entries = group[group["keys"].isna()], group[group["keys"].notna()]
        hashes, docs = _joined(entries["keys"], np.uint64), _joined(entries["docs"], np.int64)
        starts = _joined(entries["starts"], np.int32).astype(np.int64)
        size = _joined(entries["counts"], np.int32).astype(np.int64)
        signs = _joined(entries["signs"], np.uint32)
        owner = np.repeat(np.arange(len(size)), size)
        start = starts[owner] + np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
        doc, sign = docs[owner], signs[owner]
        by = np.lexsort((start, sign, doc, hashes))
        hashes, doc, sign, start = hashes[by], doc[by], sign[by], start[by]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        later = (doc != doc[head]) | (sign != sign[head]) | (start != start[head])
        return _found_rows(np.concatenate([doc[later], _joined(known["docs"], np.int64)]),
                           np.concatenate([sign[later], _joined(known["signs"], np.uint32)]),
                           np.concatenate([start[later], _joined(known["starts"], np.int32)]), buckets)

    return _by_document(index.groupBy("bucket").applyInPandas(run, FOUND))


def _with_found(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with the places found in them."""
    found = found.withColumnsRenamed({"doc_id": "_id", "sign": "_sign"})
    match = (F.col("doc_id") == F.col("_id")) & (F.col("sign") == F.col("_sign"))
    return docs.join(found, match, how).select("doc_id", "sign", "text", "found")


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, sign, found``: word positions (32-bit) at which windows begin that also begin
    earlier. ``docs`` has ``doc_id``, ``sign`` (the CRC-32 of the text) and ``text``, all without nulls."""
    if window < GRAM:
        raise ValueError(f"a window needs {GRAM} words")
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = repeated_anchors(anchor_index(docs, window, buckets), buckets)
    seeds = _with_found(docs, staged(places, "repeated-anchors"), "inner")
    return later_windows(window_index(seeds, window, buckets), buckets)


def drop_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``, and ``kept_text``, ``spans`` if asked for.

    Words end at ASCII white space. A word goes if it lies in a window of ``window`` words of one document whose words
    also begin earlier: in a document with a smaller id, or before in the same one. All windows are judged on the
    input. The kept words are joined by one space. ``spans`` are the maximal runs of words that go, as first word and
    number of words.

    Null and empty texts have no words. Rows that repeat under one id with the same text are one document: they get the
    same answer and are not earlier than each other. Texts that differ under one id are documents in order of their
    CRC-32. A row with a null id is left whole and makes nothing
    else go. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn(
        "sign", F.crc32(F.col("text").cast("binary")))
    found = staged(repeated_windows(rows.filter("doc_id is not null"), window), "repeated-windows")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, places in zip(batch["doc_id"], batch["text"], batch["found"]):
                words = text.encode().split()
                steps = np.zeros(len(words) + window + 1, np.int64)
                if places is not None:
                    at = np.unique(np.frombuffer(places, np.int32))
                    at = at[at < len(words)]
                    steps[at] += 1
                    steps[at + window] -= 1
                gone = np.cumsum(steps[:len(words)]) > 0
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)] if gone.any() else words)
                row = [None if pd.isna(doc) else int(doc), len(words), int(gone.sum()),
                       hashlib.sha256(kept).hexdigest()]
                if with_text:
                    turns = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    row += [kept.decode(), [{"start": int(a), "length": int(b - a)}
                                            for a, b in zip(turns[::2], turns[1::2])]]
                out.append(row)
            frame = pd.DataFrame(out, columns=names, dtype=object)
            yield frame.astype({"n_words": "int64", "n_removed": "int64"})

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["kept_text", "spans"] if with_text else [])
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += ", kept_text string, spans array<struct<start:int,length:int>>"
    return _with_found(rows, found, "left").mapInPandas(keep, schema)
