"""Ranked search over documents: shards of an inverted index with block maxima, searched by MaxScore.

A shard holds the documents of a few megabytes of text, so the index is built where the texts are and nothing is
shuffled. Posting lists are cut into blocks of BLOCK postings; a block keeps its competitive pairs (occurrences, terms of
the document) outside the packed postings, so that its highest score is known without unpacking it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import staged, text_or_empty

SHARD_BYTES = 8_000_000  # a shard holds about so many bytes of text; a longer text is a shard alone
BLOCK = 128
NO_ID = -(2 ** 63)  # stands for a null document id
# Items whose terms come to about so many go through the index together; more items take more passes.
PASS_TERMS = 1_000_000

_codes = np.arange(256)
IN_TERM = ((_codes >= 0x80) | ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x41) & (_codes <= 0x5A))
           | ((_codes >= 0x61) & (_codes <= 0x7A)))
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

# what a shard holds as flat little-endian numbers
FLAT = {"doc_ids": "<i8", "lengths": "<i8", "dfs": "<i4", "bases": "<i4", "gap_widths": "u1", "count_widths": "u1",
        "pair_ends": "<i4", "pair_counts": "<i4", "pair_lengths": "<i4", "postings": "u1"}
SHARDS = ("n_docs long, n_terms long, terms array<string>, "
          + ", ".join(f"{name} binary" for name in FLAT))


def terms_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms, the term number of each occurrence in order, and the occurrences per text."""
    joined = b" ".join([b"", *texts, b""]).translate(LOWER)
    data = IN_TERM[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(data[1:] != data[:-1]) + 1  # where a term begins or ends, in turn
    starts = edges[::2]
    bounds = np.cumsum([1] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(edges):
        return pa.array([], pa.string()), np.zeros(0, np.int64), counts
    entries = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [
        None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(joined)]).dictionary_encode()
    codes = entries.indices.to_numpy(zero_copy_only=False)[::2]
    used = np.zeros(len(entries.dictionary), bool)
    used[codes] = True
    number = np.cumsum(used) - 1
    return entries.dictionary.filter(pa.array(used)).cast(pa.string()), number[codes], counts


def byte_widths(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes per value in each block: 1, 2 or 4."""
    most = np.maximum.reduceat(values, starts)
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.uint8)


def build_shard(ids: list[int | None], texts: list[bytes]) -> dict | None:
    """One shard of documents; those without terms have no place in it."""
    terms, codes, counts = terms_of(texts)
    held = np.flatnonzero(counts)
    if not len(held):
        return None
    lengths = counts[held]
    doc = np.repeat(np.arange(len(held)), lengths)
    keys, tf = np.unique(codes * len(held) + doc, return_counts=True)
    term, doc = keys // len(held), keys % len(held)
    dfs = np.bincount(term, minlength=len(terms))
    nth = np.arange(len(keys)) - np.repeat(np.cumsum(dfs) - dfs, dfs)
    starts = np.flatnonzero(nth % BLOCK == 0)
    sizes = np.diff(starts, append=len(keys))
    block = np.repeat(np.arange(len(starts)), sizes)
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = 0
    gap_widths, count_widths = byte_widths(gaps, starts), byte_widths(tf, starts)
    total = (sizes * (gap_widths.astype(np.int64) + count_widths)).cumsum()
    base = np.concatenate([[0], total[:-1]])
    postings = np.zeros(int(total[-1]), np.uint8)
    inside = np.arange(len(keys)) - starts[block]
    for values, widths, lead in ((gaps, gap_widths, base), (tf, count_widths, base + sizes * gap_widths)):
        width = widths[block].astype(np.int64)
        at = lead[block] + inside * width
        for k in range(4):
            deep = width > k
            postings[at[deep] + k] = (values[deep] >> (8 * k)) & 255
    # competitive pairs: no other posting of the block has as many occurrences in as short a document
    n = lengths[doc]
    order = np.lexsort((n, -tf, block))
    falling = np.minimum.accumulate(n[order] - block[order] * (int(n.max()) + 1))
    best = order[np.concatenate([[True], falling[1:] < falling[:-1]])]
    return {"n_docs": len(held), "n_terms": int(lengths.sum()), "terms": terms,
            "doc_ids": np.array([NO_ID if ids[i] is None else ids[i] for i in held.tolist()]), "lengths": lengths,
            "dfs": dfs, "bases": doc[starts], "gap_widths": gap_widths, "count_widths": count_widths,
            "pair_ends": np.cumsum(np.bincount(block[best], minlength=len(starts))), "pair_counts": tf[best],
            "pair_lengths": n[best], "postings": postings}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The staged shards of all rows. Every row is a document of its own, also where ids repeat or are null; rows without
    a term are in no shard. An empty table has no shards. Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()
            start, size = 0, 0
            for i, text in enumerate([*texts, None]):
                if text is None or (size and size + len(text) > SHARD_BYTES):
                    shard = build_shard(ids[start:i], texts[start:i])
                    if shard is not None:
                        yield pa.RecordBatch.from_pydict({
                            "n_docs": [shard["n_docs"]], "n_terms": [shard["n_terms"]],
                            "terms": pa.ListArray.from_arrays([0, len(shard["terms"])], shard["terms"]),
                            **{name: pa.array([shard[name].astype(kind).tobytes()], pa.binary())
                               for name, kind in FLAT.items()}})
                    start, size = i, 0
                size += len(text or b"")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return staged(rows.mapInArrow(run, SHARDS), "search-index")


@dataclass
class Measure:
    """The score of a term: ``weight * ((10**9 * tf) div (1000 * tf + 20 * m))``, in 64-bit integers."""
    n_docs: int
    n_terms: int

    def impact(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 50 + (50 * length.astype(np.int64) * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m)


class Shard:
    """One shard while it is searched."""

    def __init__(self, row: dict, measure: Measure, asked: pa.Array):
        for name, kind in FLAT.items():
            setattr(self, name, np.frombuffer(row[name].as_buffer(), kind))
        self.measure = measure
        self.place = pc.index_in(asked, value_set=row["terms"].values).to_numpy(zero_copy_only=False)
        self.place = np.nan_to_num(self.place, nan=-1).astype(np.int64)
        dfs = self.dfs.astype(np.int64)
        per_term = -(-dfs // BLOCK)
        self.last_block = np.cumsum(per_term)
        self.first_block = self.last_block - per_term
        term_of = np.repeat(np.arange(len(dfs)), per_term)
        self.sizes = np.minimum(BLOCK, dfs[term_of] - (np.arange(len(term_of)) - self.first_block[term_of]) * BLOCK)
        self.ends = np.cumsum(self.sizes * (self.gap_widths.astype(np.int64) + self.count_widths))
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.maxima: dict[int, np.ndarray] = {}

    def block_maxima(self, term: int) -> np.ndarray:
        """The highest impact in every block of a list, from its competitive pairs."""
        if term not in self.maxima:
            a, b = self.first_block[term], self.last_block[term]
            ends = self.pair_ends[a:b].astype(np.int64)
            lo = int(self.pair_ends[a - 1]) if a else 0
            impacts = self.measure.impact(self.pair_counts[lo:ends[-1]], self.pair_lengths[lo:ends[-1]])
            self.maxima[term] = np.maximum.reduceat(impacts, np.concatenate([[0], ends[:-1] - lo]))
        return self.maxima[term]

    def unpack(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents of a block, and their impacts."""
        if block not in self.blocks:
            size, wide, tall = int(self.sizes[block]), int(self.gap_widths[block]), int(self.count_widths[block])
            end = int(self.ends[block])
            mid = end - size * tall
            gaps = self.postings[mid - size * wide:mid].view(f"<u{wide}").astype(np.int64)
            tf = self.postings[mid:end].view(f"<u{tall}").astype(np.int64)
            docs = np.cumsum(gaps) + int(self.bases[block])
            self.blocks[block] = (docs, self.measure.impact(tf, self.lengths[docs]))
        return self.blocks[block]

    def whole_list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of a list. Items share their frequent terms, so lists are unpacked once per shard."""
        if term not in self.lists:
            parts = [self.unpack(b) for b in range(self.first_block[term], self.last_block[term])]
            self.lists[term] = parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))
        return self.lists[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places) that may be among the k best, with their scores. Those below ``floor`` may be left out.

        Lists are taken by falling bound. While what the lists ahead can give together reaches the k-th best score so
        far, a list is essential and all its documents are candidates. From there on no new candidate can win: the other
        lists are only asked for candidates, and only in blocks whose maximum lets one of them still reach that score.
        """
        places = self.place[terms]
        there = (places >= 0) & (weights > 0)
        places, weights = places[there], weights[there]
        none = np.zeros(0, np.int64)
        if not len(places):
            return none, none
        bounds = np.array([w * int(self.block_maxima(p).max()) for p, w in zip(places.tolist(), weights.tolist())])
        order = np.argsort(-bounds, kind="stable")
        places, weights, bounds = places[order], weights[order], bounds[order]
        ahead = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])  # what list i and all after it can give
        scores = np.zeros(len(self.lengths), np.int64)
        at, threshold = 0, max(floor, 1)
        while at < len(places) and ahead[at] >= threshold:
            docs, impacts = self.whole_list(int(places[at]))
            scores[docs] += weights[at] * impacts
            at += 1
            if len(scores) > k and scores.max() > ahead[at]:  # else no list can have become non-essential
                threshold = max(threshold, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        found = np.flatnonzero(scores)
        for i in range(at, len(places)):
            found = found[scores[found] + ahead[i] >= threshold]
            if not len(found):
                return none, none
            first, last = self.first_block[places[i]], self.last_block[places[i]]
            block = np.searchsorted(self.bases[first:last], found, "right") - 1
            most = np.where(block >= 0, weights[i] * self.block_maxima(places[i])[np.maximum(block, 0)], 0)
            open_ = scores[found] + most + ahead[i + 1] >= threshold
            found, block = found[open_], block[open_]
            for b in np.unique(block[block >= 0]).tolist():
                docs, impacts = self.unpack(first + b)
                mine = found[block == b]
                spot = np.minimum(np.searchsorted(docs, mine), len(docs) - 1)
                hit = docs[spot] == mine
                scores[mine[hit]] += weights[i] * impacts[spot[hit]]
            if len(found) > k:
                threshold = max(threshold, int(np.partition(scores[found], len(found) - k)[len(found) - k]))
        found = found[scores[found] >= threshold]
        return found, scores[found]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id; null ids last."""
    order = np.lexsort((ids, ids == NO_ID, -scores))[:k]
    return scores[order], ids[order]


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, term`` once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, codes, counts = terms_of(batch.column(1).cast(pa.large_binary()).to_pylist())
            rows = np.repeat(np.arange(len(counts)), counts)
            pairs = np.unique(rows * max(len(terms), 1) + codes)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(pairs // max(len(terms), 1))),
                terms.take(pa.array(pairs % max(len(terms), 1)))], names=["item_id", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "item_id long, term string").distinct()


def _document_counts(index: DataFrame, asked: list[str]) -> dict[str, int]:
    """In how many documents each asked term is; reads the columns of terms and counts only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = pa.array(asked, pa.string()), np.zeros(len(asked), np.int64)
        for batch in batches:
            for row in batch.to_struct_array():
                place = pc.index_in(wanted, value_set=row["terms"].values)
                held = np.flatnonzero(place.is_valid())
                dfs = np.frombuffer(row["dfs"].as_buffer(), FLAT["dfs"])
                total[held] += dfs[place.drop_null().to_numpy()]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["at", "df"])

    counted = index.select("terms", "dfs").mapInArrow(run, "at long, df long").groupBy("at").agg(F.sum("df").alias("df"))
    return {asked[r["at"]]: r["df"] for r in counted.collect()}


def _heaps(index: DataFrame, items: list[tuple], measure: Measure, k: int) -> DataFrame:
    """The k best of every item in each task's shards."""
    asked = sorted({term for _, terms in items for term, _ in terms})
    number = {term: i for i, term in enumerate(asked)}
    plan = index.sparkSession.sparkContext.broadcast((asked, [
        (item_id, np.array([number[t] for t, _ in terms], np.int64), np.array([w for _, w in terms], np.int64))
        for item_id, terms in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, items = plan.value
        wanted = pa.array(asked, pa.string())
        heaps = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        for batch in batches:
            for row in batch.to_struct_array():
                shard = Shard(row, measure, wanted)
                for i, (_, terms, weights) in enumerate(items):
                    scores, ids = heaps[i]
                    floor = int(scores[-1]) if len(scores) == k else 0
                    docs, found = shard.search(terms, weights, k, floor)
                    if len(docs):
                        heaps[i] = _best(np.concatenate([scores, found]), np.concatenate([ids, shard.doc_ids[docs]]), k)
        for (item_id, _, _), (scores, ids) in zip(items, heaps):
            if len(scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array([item_id] * len(scores), pa.int64()), pa.array(ids, mask=ids == NO_ID), pa.array(scores)],
                    names=["item_id", "doc_id", "score"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long")


def weights_of(n_docs: int, counts: dict[str, int]) -> dict[str, int]:
    return {term: int(np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1)))) for term, df in counts.items()}


def search_ranked(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of the highest score above 0 for each item, ties by smaller id
    and null ids last.

    Null texts hold no terms; an item without terms, or whose terms are nowhere, has no rows. Items that share an id,
    null included, are one item with the terms of all. Every row of ``docs`` is a document, also where ids repeat. An
    empty table on either side gives no rows. Other columns are not read. Items travel to the tasks in passes of about
    PASS_TERMS terms, a bound on the broadcast; every pass searches the whole index.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col)
    terms = staged(_item_terms(items, item_col, item_text), "search-items")
    size = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    passes = -(-terms.count() // PASS_TERMS)
    if size[0] is None or not passes:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    measure = Measure(size[0], size[1])
    found: DataFrame | None = None
    for nth in range(passes):
        mine = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == nth)
        grouped = mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        counts = _document_counts(index, sorted({t for r in grouped for t in r["terms"]}))
        weights = weights_of(measure.n_docs, counts)
        plan = [(r["item_id"], [(t, weights[t]) for t in sorted(r["terms"]) if t in weights]) for r in grouped]
        heaps = _heaps(index, plan, measure, k)
        found = heaps if found is None else found.unionByName(heaps)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
