"""Main text of web pages: boosted trees over page nodes, decoded so that ancestors and descendants agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.boosting import Trees, fit_trees
from orderloom.llm.common import text_or_empty
from orderloom.llm.dom import Node, features, parse
from orderloom.llm.layouts import MARK, Layout

TRAINING_PAGES = 1000  # made-up pages that the trees are fitted on
BLOCK_CHARS = 1_500_000


def training_rows(pages: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features of the nodes with text of made-up pages, and whether any of the text below is the article's."""
    rows, labels = [], []
    for i in range(pages):
        nodes = parse(Layout(seed * 1_000_003 + i).page())
        good, some = [False] * len(nodes), [False] * len(nodes)
        for n, node in enumerate(nodes):
            if node.text:
                good[n], some[n] = MARK in node.text, True
                node.text = node.text.replace(MARK, "")
        for n in range(len(nodes) - 1, 0, -1):
            p = nodes[n].parent
            good[p], some[p] = good[p] or good[n], some[p] or some[n]
        for n, row in enumerate(features(nodes)):
            if n and some[n]:
                rows.append(row)
                labels.append(good[n])
    return np.array(rows, np.float64), np.array(labels, np.float64)


def fit_model(pages: int = TRAINING_PAGES, seed: int = 0) -> Trees:
    return fit_trees(*training_rows(pages, seed))


def decode(nodes: list[Node], scores: list[float]) -> list[bool]:
    """Which nodes stay, by the best sum of log odds over trees in which all that is below a dropped node is dropped.

    A node's score counts for it if it stays and against it if it goes; nodes without text do not count. The root
    stays.
    """
    n = len(nodes)
    keep, drop, some = [0.0] * n, [0.0] * n, [bool(node.text) for node in nodes]
    for i in range(n - 1, 0, -1):
        if some[i]:
            keep[i] += scores[i]
            drop[i] -= scores[i]
            p = nodes[i].parent
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
            some[p] = True
    stays = [True] * n
    for i in range(1, n):
        stays[i] = stays[nodes[i].parent] and keep[i] > drop[i]
    return stays


def main_texts(pages: list[str], model: Trees) -> list[str]:
    """The main text of each page: the segments that stay, in page order, with a blank line between them."""
    trees = [parse(p) for p in pages]
    rows = [features(nodes) for nodes in trees]
    scores = model.scores(np.array([r for own in rows for r in own], np.float64)).tolist()
    out, at = [], 0
    for nodes in trees:
        stays = decode(nodes, scores[at:at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(node.text for node, stay in zip(nodes, stays) if stay and node.text))
    return out


def extract(pages: DataFrame, model: Trees | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars`` (code points).

    The trees are fitted on TRAINING_PAGES made-up pages unless a model is given; any page is read whole. A segment is
    a run of text that no block boundary cuts; white space in it becomes one space.

    Null and empty pages have an empty text, as has a page without text. Markup that is not closed, or text without
    any markup, is read as far as it goes. Ids and urls pass as they are, null or repeated. An empty table gives no
    rows. Other columns are not read.
    """
    model = model or fit_model()
    shared = pages.sparkSession.sparkContext.broadcast((model.base, model.feature, model.limit, model.value))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = Trees(*shared.value)
        for batch in batches:
            htmls = batch["html"].tolist()
            texts: list[str] = []
            start, size = 0, 0
            for i, h in enumerate(htmls):
                size += len(h)
                if size > BLOCK_CHARS or i == len(htmls) - 1:
                    texts += main_texts(htmls[start:i + 1], trees)
                    start, size = i + 1, 0
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"],
                                "text": pd.Series(texts, index=batch.index, dtype=object),
                                "n_chars": pd.Series(list(map(len, texts)), index=batch.index, dtype="int64")})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(html_col).alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
