"""Packing: documents end to end as one stream of token ids, cut into windows of a fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import staged, text_or_empty
from orderloom.llm.tokens import PieceEncoder, blocks

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, tokenizer: str, spaced: bool, end_id: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``part, local_start, n_tokens, doc_id, ids``: the ids of each document (16-bit, little-endian), and the ids
    before it in its partition. Staged, so partitions and their order are fixed from here on."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at, encoder = TaskContext.get().partitionId(), 0, PieceEncoder(tokenizer, spaced)
        for batch in batches:
            texts = batch["text"].tolist()
            for block in blocks(texts):
                flat, n = encoder.encode(texts[block], end_id)
                data, ends = flat.astype("<u2").tobytes(), np.cumsum(n)
                yield pd.DataFrame({
                    "part": part, "local_start": at + ends - n, "n_tokens": n, "doc_id": batch["doc_id"].iloc[block],
                    "ids": [data[2 * (e - k):2 * e] for e, k in zip(ends.tolist(), n.tolist())]})
                at += int(ends[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return staged(rows.mapInPandas(
        encode, "part long, local_start long, n_tokens long, doc_id long, ids binary"), "encoded")


def concat_and_cut(rows: DataFrame, window: int) -> DataFrame:
    """The pieces of PIECES that windows of ``window`` ids cut from the stream of `encoded` rows.

    First pass: the ids of each partition are summed, and prefix sums over these totals give every partition its
    place in the stream. Second pass: a document's pieces follow from its place alone. A document over a window's
    edge leaves a boundary piece on either side. Only the last window is not full.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    bases = totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    # one row per partition of the input, two numbers each
    placed = rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("_base") + F.col("local_start")).alias("at"), "n_tokens", "ids")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, n = batch["at"].to_numpy(np.int64), batch["n_tokens"].to_numpy(np.int64)
            first = at // window
            count = (at + n - 1) // window - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = np.maximum(sequence * window, at[doc]) - at[doc]
            length = np.minimum((sequence + 1) * window, (at + n)[doc]) - at[doc] - start
            ids = [np.frombuffer(x, "<u2").astype("<u4") for x in batch["ids"]]
            crcs = [zlib.crc32(ids[d][s:s + k].tobytes())
                    for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].iloc[doc], "start": start, "length": length, "ids_crc32": crcs,
                "doc_tokens": n[doc], "sequence_id": sequence, "offset": at[doc] + start - sequence * window})

    return placed.mapInPandas(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, spaced: bool, end_id: int, window: int = 1024, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The pieces of all documents, in the order of the input's partitions.

    Null and empty texts are the end id alone. Rows that repeat under one id are packed each; a null id stays null.
    An empty table gives no rows. Other columns are not read.
    """
    return concat_and_cut(encoded(docs, tokenizer, spaced, end_id, id_col, text_col), window)
