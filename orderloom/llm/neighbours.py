"""Approximate nearest neighbours by cross-polytope hashing, multiprobe tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderloom.llm.common import staged

TABLES, PROBES, HASHES, SEED = 8, 16, 1, 7
CHUNK = 20_000  # vectors, and queries, that one task compares at a time; fuller buckets are dealt to several tasks
SMALL_BAND = 2_000  # vectors up to which a band of its own length is one bucket: hashing finds the few among many
BAND = 1.25  # the longest vectors of a band are so many times as long as its shortest
NEAR_TIE = 1e-9
ENTRY = "t int, band int, bucket long, dim int, n int, ids binary, vectors binary"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, scaled to keep lengths; rows have a power of two of entries."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def probed(x: np.ndarray, table: int, probes: int, hashes: int, seed: int) -> np.ndarray:
    """The ``probes`` nearest buckets of each unit vector in a table, nearest first.

    Each of the ``hashes`` functions turns the vector by three rounds of random signs and the Hadamard transform and
    names the nearest signed axis; the loss of another axis is how much shorter the projection on it is.
    """
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, :x.shape[1]] = x
    codes, losses = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    rows = np.arange(len(x))[:, None]
    for k in range(hashes):
        signs = np.random.default_rng([seed, table, k, width]).choice([-1.0, 1.0], (3, width))
        y = padded
        for s in signs:
            y = hadamard(y * s)
        y = np.concatenate([y, -y], axis=1)
        axes = np.argsort(-y, axis=1, kind="stable")[:, :probes]
        value = y[rows, axes]
        loss = (losses[:, :, None] + (value[:, :1] - value)[:, None, :]).reshape(len(x), -1)
        code = (codes[:, :, None] * (2 * width) + axes[:, None, :]).reshape(len(x), -1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        codes, losses = code[rows, best], loss[rows, best]
    return codes


def _clean(batch: pd.DataFrame, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by length; vectors null, empty, zero or with null or non-finite components are left out."""
    by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, v in zip(batch["vec_id"], batch["embedding"]):
        if v is None or pd.isna(i) or not len(v):
            continue
        v = np.array([np.nan if c is None else c for c in v], kind) if v.dtype == object else v.astype(kind)
        if np.isfinite(v).all() and v.any():
            by_length.setdefault(len(v), []).append((int(i), v))
    for found in by_length.values():
        yield np.array([i for i, _ in found], np.int64), np.stack([v for _, v in found])


def band_of(norms: np.ndarray) -> np.ndarray:
    return np.floor(np.log(norms) / np.log(BAND) + 1e-12).astype(np.int64)


def entries(vectors: DataFrame, kind: str, tables: int, probes: int, hashes: int, seed: int, lifted: bool,
            bands: list[int] | None, whole: frozenset[int] = frozenset()) -> DataFrame:
    """Rows of ENTRY: vectors packed by table and bucket; with ``tables`` 0 all are in one bucket.

    Where lengths differ, vectors are in tables by bands of length, and a further coordinate makes those of a band
    equally long, so that the nearest by angle are those with the largest inner product. ``bands`` is null for the
    vectors to index, and for queries, which look into the tables of every band, the bands there are. A band in
    ``whole`` is one bucket.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, x in _clean(batch, kind):
                out = []
                wide = x.astype(np.float64)
                norms = np.linalg.norm(wide, axis=1)
                unit = wide / norms[:, None]
                for band in [None] if bands is None else bands:
                    own_band = np.full(len(x), band) if band is not None else band_of(norms) if lifted else 0 * norms
                    turned = unit
                    if lifted and bands is None:
                        share = norms / BAND ** (own_band + 1)
                        turned = np.concatenate([unit * share[:, None], np.sqrt(np.maximum(0, 1 - share ** 2))[:, None]], 1)
                    elif lifted:
                        turned = np.concatenate([unit, np.zeros((len(x), 1))], axis=1)
                    for t in range(max(tables, 1)):
                        codes = probed(turned, t, probes, hashes, seed) if tables else np.zeros((len(x), 1), np.int64)
                        owner = np.repeat(np.arange(len(x)), codes.shape[1])
                        place = np.stack([own_band.astype(np.int64)[owner], codes.ravel()])
                        if whole:
                            first = np.arange(len(owner)) % codes.shape[1] == 0
                            plain = np.isin(place[0], list(whole))
                            place[1, plain] = -1
                            stays = ~plain | (first & (t == 0))
                            place, owner = place[:, stays], owner[stays]
                            if not len(owner):
                                continue
                        by = np.lexsort(place[::-1])
                        place, owner = place[:, by], owner[by]
                        edges = np.flatnonzero(np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(axis=0)]))
                        edges = edges.tolist()
                        for a, b in zip(edges, edges[1:] + [len(owner)]):
                            own = owner[a:b]
                            out.append((t, int(place[0, a]), int(place[1, a]), x.shape[1], b - a, ids[own].tobytes(),
                                        x[own].tobytes()))
                yield pd.DataFrame(out, columns=["t", "band", "bucket", "dim", "n", "ids", "vectors"])

    return vectors.select("vec_id", "embedding").mapInPandas(run, ENTRY)


def best_of_buckets(index: DataFrame, queries: DataFrame, kind: str, k: int) -> DataFrame:
    """``query_id, vec_id, score``: of every bucket that a query looks into, its k best there.

    Buckets with more than CHUNK vectors or queries are dealt out by blocks: each block of vectors meets each block
    of queries in a task of its own. The table of bucket sizes has a row for each bucket and not for each vector.
    """
    place = ["t", "band", "bucket", "dim"]
    sizes = index.groupBy(*place).agg(F.sum("n").alias("nv")).join(
        queries.groupBy(*place).agg(F.sum("n").alias("nq")), place)
    blocks = staged(sizes.select(*place, F.ceil(F.col("nv") / CHUNK).alias("bv"), F.ceil(F.col("nq") / CHUNK)
                                 .alias("bq")), "buckets")

    def dealt(own: str, other: str) -> tuple[Column, Column]:
        # both sides need one type, or equal keys would be dealt to different tasks
        return (F.pmod(F.xxhash64("ids"), F.col(own)).cast("int").alias(own + "_at"),
                F.explode(F.sequence(F.lit(0), F.col(other).cast("int") - 1)).alias(other + "_at"))

    x = index.join(blocks, place).select(*place, "ids", "vectors", *dealt("bv", "bq"))
    q = queries.join(blocks, place).select(*place, "ids", "vectors", *dealt("bq", "bv"))
    cell = [*place, "bv_at", "bq_at"]

    def unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        # by id, and rows that are the same once
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in group["ids"]])
        x = np.concatenate([np.frombuffer(b, kind) for b in group["vectors"]]).reshape(len(ids), -1)
        by = np.argsort(ids, kind="stable")
        ids, x = ids[by], x[by]
        if (ids[1:] == ids[:-1]).any():
            row = np.concatenate([ids.view(np.uint8).reshape(len(ids), -1),
                                  np.ascontiguousarray(x).view(np.uint8).reshape(len(ids), -1)], axis=1)
            once = np.sort(np.unique(row.view(f"V{row.shape[1]}").ravel(), return_index=True)[1])
            ids, x = ids[once], x[once]
        return ids, x.astype(np.float64)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64"})]
        if len(left) and len(right):
            vec_ids, vectors = unpacked(left)
            query_ids, points = unpacked(right)
            # the k best are ids and not rows: an id counts by the best of its rows
            starts = np.flatnonzero(np.concatenate([[True], vec_ids[1:] != vec_ids[:-1]]))
            copies = np.diff(np.append(starts, len(vec_ids)))
            for a in range(0, len(points), 256):
                own = query_ids[a:a + 256]
                scores = points[a:a + 256] @ vectors.T
                scores[own[:, None] == vec_ids[None, :]] = -np.inf
                best = scores if len(starts) == len(vec_ids) else np.maximum.reduceat(scores, starts, axis=1)
                top = min(k, len(starts))
                least = np.partition(best, len(starts) - top, axis=1)[:, len(starts) - top]
                floor = np.maximum(best, least[:, None]) - NEAR_TIE
                if best is not scores:
                    floor = np.repeat(floor, copies, axis=1)
                row, col = np.nonzero((scores >= floor) & np.isfinite(scores))
                # a pair's score must not depend on the block it was found in
                exact = np.einsum("ij,ij->i", points[a + row], vectors[col])
                by = np.lexsort((-exact, vec_ids[col], row))
                row, col, exact = row[by], col[by], exact[by]
                first = np.ones(len(row), bool)
                first[1:] = (row[1:] != row[:-1]) | (vec_ids[col[1:]] != vec_ids[col[:-1]])
                row, col, exact = row[first], col[first], exact[first]
                by = np.lexsort((vec_ids[col], -exact, row))
                row, col, exact = row[by], col[by], exact[by]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                out.append(pd.DataFrame({"query_id": own[row[keep]], "vec_id": vec_ids[col[keep]],
                                         "score": exact[keep]}))
        return pd.concat(out)

    return x.groupBy(*cell).cogroup(q.groupBy(*cell)).applyInPandas(
        search, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, probes: int = PROBES,
            hashes: int = HASHES, seed: int = SEED, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows where ``is_query``, the k others found with the largest inner
    products, nearest first, ties to the smaller id.

    Every vector is indexed once in each of ``tables`` tables, and a query looks into ``probes`` buckets of each (of
    each band and twice as many, where lengths differ). A
    query that finds fewer than k is compared with all vectors, in blocks. A table has twice as many buckets as
    coordinates, to the power ``hashes``: with one hash a query is compared with a constant share of all vectors;
    raise ``hashes`` by one for each factor of about a hundred beyond a few million vectors, and ``tables`` with it.

    Vectors null, empty, zero or with null or non-finite components take no part, nor do rows with a null id.
    Vectors are compared with those of their own length only. Rows that repeat under one id are one candidate, with
    the best score among them, and none of them is a candidate of a query of that id. An empty table gives no rows.
    Other columns are read only by ``is_query``.
    """
    kind = "<f8" if "double" in vectors.select(vector_col).dtypes[0][1] else "<f4"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.coalesce(is_query, F.lit(False)).alias("_query"))

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, x in _clean(batch, kind):
                norms = np.linalg.norm(x.astype(np.float64), axis=1)
                yield pd.DataFrame({"band": band_of(norms), "norm": norms})

    # a few hundred bands at most: they follow from the exponents of floating-point numbers
    found = (rows.select("vec_id", "embedding").mapInPandas(lengths, "band int, norm double").groupBy("band")
             .agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"), F.count(F.lit(1)).alias("n")).collect())
    lifted = bool(found) and max(r.hi for r in found) > min(r.lo for r in found) * (1 + 1e-6)
    bands = sorted(r.band for r in found) if lifted else [0]
    probes = 2 * probes if lifted else probes
    whole = frozenset(r.band for r in found if lifted and r.n <= SMALL_BAND)
    points = rows.filter("_query")
    index = staged(entries(rows, kind, tables, 1, hashes, seed, lifted, None, whole), "vector-index")
    queries = staged(entries(points, kind, tables, probes, hashes, seed, lifted, bands, whole), "query-probes")
    hits = best_of_buckets(index, queries, kind, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top(pairs: DataFrame) -> DataFrame:
        best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    ranked = staged(top(hits), "ranked")
    counts = ranked.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k).select("query_id")
    short = staged(points.join(counts, F.col("vec_id") == F.col("query_id"), "left_anti"), "short-queries")
    if not short.isEmpty():
        everything = entries(rows, kind, 0, 1, hashes, seed, False, None)
        again = top(best_of_buckets(staged(everything, "all-vectors"),
                                    staged(entries(short, kind, 0, 1, hashes, seed, False, [0]), "short-probes"),
                                    kind, k))
        ranked = ranked.join(counts, "query_id", "left_semi").unionByName(again)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
