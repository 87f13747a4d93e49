"""Token ids as flat unsigned integers with 64-bit document offsets, written in id order and memory-mapped back."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import staged, text_or_empty
from orderloom.llm.tokens import PieceEncoder, blocks

# Fixed: ids fit in 16 bits for every vocabulary of up to 65,536 entries.
ID_TYPE, OFFSET_TYPE, DOC_TYPE = "<u2", "<u8", "<i8"
NO_ID = -(2 ** 63)  # stands for a null document id
READ_DOCS = 20_000


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _mapped(folder_fs, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is a mounted one, else read."""
    from pyarrow import fs

    size = folder_fs.get_file_info(path).size
    if not size:
        return np.zeros(0, kind)
    if isinstance(folder_fs, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    return np.frombuffer(folder_fs.open_input_file(path).read(), kind)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, spaced: bool, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``name.ids`` (token ids), ``name.offsets`` (one more than documents, from 0) and ``name.docs`` (document
    ids) for each range of document ids, and return the manifest: ``part, name, n_docs, n_tokens, base``.

    ``base`` is the number of ids in all files before, a prefix sum over one row per file; base plus offset is a
    document's place in the whole corpus. A retried task writes files of another name, and the manifest names those
    of the attempt that Spark committed.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        folder_fs, root = _filesystem(folder)
        folder_fs.create_dir(root, recursive=True)
        encoder = PieceEncoder(tokenizer, spaced)
        lengths, ids = [np.zeros(1, np.int64)], []
        with folder_fs.open_output_stream(f"{root}/{name}.ids") as out:
            for batch in batches:
                texts = batch["text"].tolist()
                for block in blocks(texts):
                    flat, n = encoder.encode(texts[block], end_id)
                    out.write(flat.astype(ID_TYPE).tobytes())
                    lengths.append(n)
                ids.append(batch["doc_id"].fillna(NO_ID).to_numpy(DOC_TYPE))
        if not ids:
            folder_fs.delete_file(f"{root}/{name}.ids")
            return
        offsets = np.cumsum(np.concatenate(lengths))
        for kind, values in (("offsets", offsets.astype(OFFSET_TYPE)), ("docs", np.concatenate(ids))):
            with folder_fs.open_output_stream(f"{root}/{name}.{kind}") as out:
                out.write(values.tobytes())
        yield pd.DataFrame({"part": [part], "name": pd.Series([name], dtype=object), "n_docs": [len(offsets) - 1],
                            "n_tokens": [int(offsets[-1])]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = staged(ordered.mapInPandas(write, "part long, name string, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return staged(files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``, a task for each file."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder_fs, root = _filesystem(folder)
        for batch in batches:
            for name, base in zip(batch["name"], batch["base"]):
                ids, offsets, docs = (_mapped(folder_fs, f"{root}/{name}.{kind}", t) for kind, t in (
                    ("ids", ID_TYPE), ("offsets", OFFSET_TYPE), ("docs", DOC_TYPE)))
                at = offsets.astype(np.int64)
                for i in range(0, len(docs), READ_DOCS):
                    own = docs[i:i + READ_DOCS]
                    bounds = at[i:i + len(own) + 1]
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                    yield pd.DataFrame({"doc_id": pd.Series(own, dtype="Int64").mask(own == NO_ID),
                                        "start": bounds[:-1] + base, "n_tokens": np.diff(bounds), "ids_crc32": crcs})

    files = manifest.count()
    dealt = manifest.select("name", "base").coalesce(1).repartition(max(files, 1))
    return dealt.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, folder: str, tokenizer: str, spaced: bool, end_id: int,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files and read every document back from them.

    Null and empty texts hold the end id alone. Rows that repeat under one id lie side by side, in order of their
    texts; null ids come first. An empty table gives no files and no rows. Other columns are not read.
    """
    manifest = write_token_files(docs, folder, tokenizer, spaced, end_id, id_col, text_col)
    return read_token_files(docs.sparkSession, folder, manifest)
