"""From raw documents to packed sequences of tokens, in five stages.

Every stage takes all rows that the one before it kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm.common import staged, table
from orderloom.llm.exact_dedup import drop_copies
from orderloom.llm.language import keep_identified
from orderloom.llm.mixing import mix
from orderloom.llm.ngram_join import keep_one_of_each
from orderloom.llm.packing import pack

TOKENIZER, END_ID, WINDOW = public_tokenizers.path("byte_bpe_50k.json"), 0, 1024

# A conditional random field and a tokenizer have no SQL; tests compare run() with a plain version in Python.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language; texts without letters and wild mixtures go."""
    return keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return drop_copies(docs, keep="smallest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.75 or more join, the one with the smallest id."""
    return keep_one_of_each(docs, words=5, least=(75, 100))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the square root of their sizes: each document as often as its Poisson draw says, shuffled."""
    return mix(docs, temper=0.5).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of WINDOW tokens."""
    return pack(docs, TOKENIZER, spaced=True, end_id=END_ID, window=WINDOW)


STAGES = [("language ID", language), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("mixing sources to target weights", mixture), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between stages the rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
