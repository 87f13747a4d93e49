"""N-gram Jaccard join with token-combination prefixes.

A document's tokens are the hashes of its distinct runs of five words. All tokens have one order, rare before frequent.
Two sets that reach the threshold share a token of their prefixes (the first n - ceil(t n) + 1 tokens of a set of n);
if their first shared token is frequent, all they share are, and prefixes longer by m share m + 1 frequent tokens. So

* rare tokens of the prefix are indexed one by one;
* frequent tokens of the extended prefix are dealt by hash into m classes, and indexed as combinations of two of one
  class: of m + 1 shared tokens, two must be of one class. m is an eighth of the size, rounded down to a power of two,
  of the larger set; each set is indexed for every m that its partners can have.

Each entry of the index says how many of its set's tokens can be shared if this key is the first one that a pair shares:
those from it on, or, as two of the first m + 1 are of one class, m and those from the later of the two on. A pair
meets only where that is enough for the threshold.

Sets that meet in the index are compared by a short bitmap, which can only rule out, and then verified on all their
tokens. Which tokens count as frequent only decides the work
and never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import attach_groups, staged, text_or_empty
from orderloom.llm.components import components
from orderloom.llm.words import byte_blocks, mixed, run_hashes, whole_hash, word_hashes

COUNT_TOKENS = 4_000_000  # tokens are counted in rounds of about so many; those repeated in a round are reported
REPORT_FROM = 3
FREQUENT_FROM = 12  # reports that make a token frequent
FREQUENT_LIMIT = 200_000  # the most frequent ones travel to every task: 1.8 MB at most; any others count as rare
FLUSH_POSTINGS = 1_000_000
SMALL_RUN = 8  # sets under one key up to which all its pairs are candidates at once
BUCKETS_PER_PARTITION = 4
SIGN_BITS = 1024
BLOCK_SETS = 1_000  # sets of a crowd that are compared with each other, or with another block, at a time
BLOCK_PAIRS = 500  # partners of a document that one task compares with it


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct token hashes of each text."""
    raw = [t.encode().lower() for t in texts]
    out: list[np.ndarray] = []
    for block in byte_blocks(raw):
        hashes, counts = word_hashes(raw[block])
        runs = run_hashes(hashes, words)
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if b - a >= words:
                out.append(np.unique(runs[a:b - words + 1]))
            elif b > a:
                out.append(np.array([whole_hash(hashes[a:b])], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _blocks(batch: pd.DataFrame, words: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 3_000_000 or i == len(texts) - 1:
            yield ids[start:i + 1], shingle_sets(texts[start:i + 1], words)
            start, size = i + 1, 0


def _bits(tokens: np.ndarray) -> bytes:
    marks = np.zeros(SIGN_BITS, bool)
    marks[(tokens % np.uint64(SIGN_BITS)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def describe(docs: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows: ``doc_id, n, sign, bits`` per document, and ``token, copies`` per token that a task saw
    often. ``bits`` marks the remainders of a set's tokens when divided by SIGN_BITS."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        kept: list[np.ndarray] = []
        held = 0

        def counted() -> pd.DataFrame:
            tokens, copies = np.unique(np.concatenate(kept), return_counts=True)
            often = copies >= REPORT_FROM
            return pd.DataFrame({"doc_id": None, "n": None, "sign": None, "bits": None,
                                 "token": tokens[often].view(np.int64), "copies": copies[often]})

        for batch in batches:
            for ids, sets in _blocks(batch, words):
                signs = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="Int64"), "n": [len(s) for s in sets],
                                    "sign": pd.Series([s and s.hex() for s in signs], dtype=object),
                                    "bits": pd.Series([_bits(s) for s in sets], dtype=object),
                                    "token": None, "copies": None})
                for s, sign in zip(sets, signs):
                    if sign and sign not in seen:
                        seen.add(sign)
                        kept.append(s)
                        held += len(s)
                if held >= COUNT_TOKENS:
                    yield counted()
                    kept, held = [], 0
        if kept:
            yield counted()

    return docs.mapInPandas(run, "doc_id long, n long, sign string, bits binary, token long, copies long")


def _prefix_keys(tokens: np.ndarray, classes: np.ndarray, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The index keys of one set, and for each how many tokens can be shared; ``classes`` is 0 for rare tokens and
    grows with frequency."""
    num, den = least
    n = len(tokens)
    prefix = n - -(-num * n // den) + 1
    frequent = np.flatnonzero(classes)
    rare = n - len(frequent)
    keys = [np.delete(tokens, frequent)[:prefix] if len(frequent) else tokens[:prefix]]
    rest = [n - np.arange(len(keys[0]))]
    order = frequent[np.argsort(classes[frequent], kind="stable")]
    for level in range(n.bit_length(), (n * den // num).bit_length() + 1):
        m = max(1, 2 ** (level - 1) // 8)
        chosen = tokens[order[:max(prefix + m - rare, 0)]]
        if len(chosen) < 2:
            continue
        group = (mixed(chosen) % np.uint64(m)).astype(np.int64)
        by = np.lexsort((chosen, group))
        chosen, group = chosen[by], group[by]
        place = rare + by
        for gap in range(1, int(np.bincount(group).max())):
            same = group[gap:] == group[:-gap]
            pair = mixed(chosen[:-gap][same] + np.uint64(level)) ^ chosen[gap:][same]
            keys.append(mixed(pair))
            # both are among the first m + 1 shared tokens, so what else is shared comes behind the later one
            later = np.maximum(place[:-gap][same], place[gap:][same])
            rest.append(np.minimum(len(frequent), m + n - later))
    return np.concatenate(keys), np.concatenate(rest)


def postings(docs: DataFrame, words: int, least: tuple[int, int], frequent: tuple[np.ndarray, np.ndarray],
             buckets: int) -> DataFrame:
    """The index, as ``bucket`` and arrays of keys, ids, set sizes and tokens to share; equal sets of a task are
    indexed once."""
    common = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, ranks = common.value
        seen: set[bytes] = set()
        keys, rests, owners, sizes, held = [], [], [], [], 0

        def flushed() -> pd.DataFrame:
            key = np.concatenate(keys)
            counts = [len(k) for k in keys]
            owner, size = np.repeat(np.array(owners, np.int64), counts), np.repeat(np.array(sizes, np.int32), counts)
            rest = np.concatenate(rests).astype(np.int32)
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            key, owner, size, rest, bucket = key[by], owner[by], size[by], rest[by], bucket[by]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            spans = list(zip(edges, edges[1:] + [len(key)]))
            return pd.DataFrame({"bucket": bucket[edges], "keys": [key[a:b].tobytes() for a, b in spans],
                                 "ids": [owner[a:b].tobytes() for a, b in spans],
                                 "sizes": [size[a:b].tobytes() for a, b in spans],
                                 "rests": [rest[a:b].tobytes() for a, b in spans]})

        for batch in batches:
            for ids, sets in _blocks(batch, words):
                for doc, tokens in zip(ids, sets):
                    if len(tokens) < 2 or pd.isna(doc):
                        continue
                    sign = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                    if sign in seen:
                        continue
                    seen.add(sign)
                    if len(names):
                        at = np.minimum(np.searchsorted(names, tokens), len(names) - 1)
                        ranked = np.where(names[at] == tokens, ranks[at], 0)
                    else:
                        ranked = np.zeros(len(tokens), np.int8)
                    own, rest = _prefix_keys(tokens, ranked, least)
                    keys.append(own)
                    rests.append(rest)
                    owners.append(int(doc))
                    sizes.append(len(tokens))
                    held += len(own)
                    if held >= FLUSH_POSTINGS:
                        yield flushed()
                        keys, rests, owners, sizes, held = [], [], [], [], 0
        if keys:
            yield flushed()

    return docs.mapInPandas(run, "bucket long, keys binary, ids binary, sizes binary, rests binary")


def meetings(index: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Candidates from the index: ``key`` null and a pair ``a, b`` of ids; or, under a key with many sets, ``key``,
    the id ``a``, its size ``b`` and the tokens it can share, ``c``. Of the latter, neighbours in size and each
    with the smallest id are pairs too."""
    num, den = least

    def run(group: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"]])
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in group["ids"]])
        size = np.concatenate([np.frombuffer(x, np.int32) for x in group["sizes"]]).astype(np.int64)
        rest = np.concatenate([np.frombuffer(x, np.int32) for x in group["rests"]]).astype(np.int64)
        by = np.lexsort((ids, size, key))
        key, ids, size, rest = key[by], ids[by], size[by], rest[by]
        # a set without another of fitting size under its key has no partner there; its neighbour is the nearest
        fits = (key[1:] == key[:-1]) & (size[1:] * num <= size[:-1] * den)
        alive = np.zeros(len(key), bool)
        alive[1:] |= fits
        alive[:-1] |= fits
        key, ids, size, rest = key[alive], ids[alive], size[alive], rest[alive]
        edges = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
        length = np.diff(edges, append=len(key))
        run_of = np.repeat(np.arange(len(edges)), length)
        many = length > SMALL_RUN
        found = []

        def add(x: np.ndarray, y: np.ndarray) -> None:
            ok = size[x] * num <= size[y] * den
            ok &= size[y] * num <= size[x] * den
            ok &= np.minimum(rest[x], rest[y]) * (num + den) >= num * (size[x] + size[y])
            a, b = ids[x[ok]], ids[y[ok]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b])

        for gap in range(1, SMALL_RUN):
            x = np.flatnonzero(run_of[gap:] == run_of[:-gap]) if len(key) > gap else np.zeros(0, np.int64)
            if gap > 1:
                x = x[~many[run_of[x]]]
            add(x, x + gap)
        big = np.flatnonzero(many[run_of]) if len(key) else np.zeros(0, np.int64)
        if len(big):
            lowest = np.minimum.reduceat(ids, edges)
            first = np.lexsort((ids, run_of))[edges]  # where the smallest id of each run stands
            assert (ids[first] == lowest).all()
            add(first[run_of[big]], big)
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({
            "key": pd.array([None] * len(pairs) + key[big].view(np.int64).tolist(), dtype="Int64"),
            "a": np.concatenate([pairs[:, 0], ids[big]]), "b": np.concatenate([pairs[:, 1], size[big]]),
            "c": np.concatenate([np.zeros(len(pairs), np.int64), rest[big]])})

    return index.groupBy("bucket").applyInPandas(run, "key long, a long, b long, c long")


def _similar(x: np.ndarray, y: np.ndarray, least: tuple[int, int]) -> bool:
    num, den = least
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    shared = int((x[at] == y).sum())
    return shared > 0 and den * shared >= num * (len(x) + len(y) - shared)


def possible(pairs: DataFrame, described: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` that their bits do not rule out: every mark that one set alone has is a token the other lacks."""
    num, den = least
    sets = described.filter("token is null and doc_id is not null").select("doc_id", "n", "bits")
    x = sets.toDF("a", "na", "x")
    y = sets.toDF("b", "nb", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch[c]), np.uint64).reshape(len(batch), -1) for c in ("x", "y"))
            na, nb = batch["na"].to_numpy(np.int64), batch["nb"].to_numpy(np.int64)
            shared = np.minimum(na - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64),
                                nb - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
            yield batch.loc[(num + den) * shared >= num * (na + nb), ["a", "b"]]

    return pairs.join(x, "a").join(y, "b").mapInPandas(run, "a long, b long").distinct()


def verified(docs: DataFrame, pairs: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a < b) of documents whose sets reach the threshold.

    The texts of all b of one a travel to the text of a. An a with more than BLOCK_PAIRS partners is dealt to several
    tasks, each with a text of a, so no task holds all partners of one document.
    """
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK_PAIRS).cast("int").alias("n"))
    heads = blocks.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"),
                          F.lit(0).alias("role"))
    members = pairs.join(blocks, "a").select(
        F.col("b").alias("id"), "a", F.pmod(F.hash("b"), F.col("n")).alias("block"), F.lit(1).alias("role"))
    wanted = staged(heads.unionByName(members), "wanted")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, heads = None, []
        for batch in batches:
            a, b, i = [], [], 0
            place = list(zip(batch["a"].tolist(), batch["block"].tolist()))
            roles = batch["role"].tolist()
            for ids, sets in _blocks(batch, words):
                for doc, own in zip(ids, sets):
                    if place[i] != at:
                        at, heads = place[i], []
                    if roles[i] == 0:
                        heads.append(own)
                    elif any(_similar(x, own, least) for x in heads):
                        a.append(at[0])
                        b.append(doc)
                    i += 1
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    # documents to compare grow with the documents, so they are not broadcast, also while they are few
    met = docs.join(wanted.hint("merge"), F.col("doc_id") == F.col("id")).select("a", "block", "role", "doc_id", "text")
    return (met.repartition("a", "block").sortWithinPartitions("a", "block", "role")
            .mapInPandas(compare, "a long, b long").distinct())


def apart_pairs(crowd: DataFrame, least: tuple[int, int], buckets: int) -> DataFrame:
    """Pairs ``a, b`` of rows of ``crowd`` (``key, a, n, c, label``) with one key and different labels, if their sizes
    and the tokens they can share allow the threshold.

    Keys with the same smallest id mostly hold the same sets, so their pairs are found together and told once. The
    sets of such keys are cut into blocks of about BLOCK_SETS, and each pair of blocks is a task's work of its own.
    """
    num, den = least
    keys = (crowd.groupBy("key").agg(F.min("a").alias("first"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .filter("lo <> hi").select("key", "first"))
    rows = staged(crowd.join(keys, "key"), "crowds-apart")
    rows = rows.withColumn("_first", F.col("first").cast("string"))
    blocks = staged(rows.groupBy("_first").agg(
        F.count(F.lit(1)).alias("size"), F.ceil(F.approx_count_distinct("a") / BLOCK_SETS).cast("int").alias("blocks")),
        "crowd-blocks")
    own = F.pmod(F.hash("a"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # the rows of a large crowd learn its number of blocks where they are
    dealt = attach_groups(rows, blocks, "_first", "size", "a").withColumn("own", own).withColumn("other", other).select(
        "first", "key", "a", "n", "c", "label", "own", F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("first", "i", "j"), F.lit(buckets)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["first", "i", "j", "key"])
        a, n, c, label, own, i, j = (group[x].to_numpy(np.int64) for x in ("a", "n", "c", "label", "own", "i", "j"))
        place = group[["first", "i", "j", "key"]].to_numpy(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1)])).tolist()
        kept, held = [np.zeros((0, 2), np.int64)], 0
        for lo, hi in zip(edges, edges[1:] + [len(a)]):
            span = slice(lo, hi)
            if i[lo] == j[lo]:
                x, y = np.triu_indices(hi - lo, 1)
            else:
                x, y = (v.ravel() for v in np.meshgrid(np.flatnonzero(own[span] == i[lo]),
                                                       np.flatnonzero(own[span] == j[lo])))
            x, y = x + lo, y + lo
            ok = ((label[x] != label[y]) & (n[x] * num <= n[y] * den) & (n[y] * num <= n[x] * den)
                  & (np.minimum(c[x], c[y]) * (num + den) >= num * (n[x] + n[y])))
            if ok.any():
                kept.append(np.stack([np.minimum(a[x[ok]], a[y[ok]]), np.maximum(a[x[ok]], a[y[ok]])], axis=1))
                held += len(kept[-1])
            if held > 2_000_000:
                kept, held = [np.unique(np.concatenate(kept), axis=0)], 0
        pairs = np.unique(np.concatenate(kept), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("bucket").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, least: tuple[int, int] = (75, 100), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Two documents link when the Jaccard similarity of their sets of ``words``-word shingles is at least ``least``.
    Words end at ASCII white space, and A-Z are lower-cased. A text of fewer words is one shingle. ``component_id``
    is the smallest id that links reach.

    Null and empty texts have no shingles and link with nothing. Rows that repeat under one id are one document as
    far as links go. A row with a null id has no component. An empty table gives no rows. Other columns are not read.
    Shingles are 64-bit hashes; equal sets are told by 128 bits.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    described = staged(describe(docs, words), "described")
    rows = described.filter("token is null").select("doc_id", "n", F.coalesce(
        "sign", F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("sign"))
    often = (described.filter("token is not null").groupBy("token").agg(F.sum("copies").alias("copies"))
             .filter(F.col("copies") >= FREQUENT_FROM).orderBy(F.desc("copies"), "token").limit(FREQUENT_LIMIT)
             .toPandas())
    names = often["token"].to_numpy(np.int64).view(np.uint64)
    ranks = np.log2(often["copies"].to_numpy(np.float64)).astype(np.int8)
    by = np.argsort(names)
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(meetings(postings(docs, words, least, (names[by], ranks[by]), buckets), least), "meetings")

    # equal sets are one node, named by the smallest id
    groups = staged(rows.groupBy("sign").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "sets")
    moved = staged(attach_groups(rows.filter("doc_id is not null"), groups, "sign", "size", "doc_id")
                   .filter("rep <> doc_id").select(F.col("doc_id").alias("_from"), "rep").distinct(), "copies")

    def to_rep(df: DataFrame, column: str) -> DataFrame:
        return (df.join(moved, F.col(column) == F.col("_from"), "left")
                .withColumn(column, F.coalesce("rep", column)).drop("_from", "rep"))

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()

    pairs = found.filter("key is null").select("a", "b").distinct()
    tried = staged(ordered(to_rep(to_rep(pairs, "a"), "b")), "pairs")
    links = staged(verified(docs, staged(possible(tried, described, least), "possible"), words, least), "verified")

    # under keys with many sets, pairs that links have not joined yet are compared too
    crowd = to_rep(found.filter("key is not null").withColumnRenamed("b", "n"), "a").distinct()
    labels = components(links)
    crowd = staged(crowd.join(labels, F.col("a") == F.col("id"), "left").select(
        "key", "a", "n", "c", F.coalesce("label", "a").alias("label")), "crowds")
    more = ordered(apart_pairs(crowd, least, buckets))
    more = staged(possible(more.join(tried, ["a", "b"], "left_anti"), described, least), "more-pairs")
    if not more.isEmpty():
        bridges = staged(verified(docs, more, words, least), "bridges")
        if not bridges.isEmpty():
            labels = components(links.union(bridges))
    named = groups.join(labels, F.col("rep") == F.col("id"), "left").select(
        "sign", "size", F.coalesce("label", "rep").alias("component_id"))
    return attach_groups(rows, staged(named, "named-sets"), "sign", "size", "doc_id").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, least: tuple[int, int] = (75, 100), id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that a smaller id reaches by links. Rows with a null id stay."""
    found = near_duplicates(docs, words, least, id_col, text_col)
    kept = found.filter("component_id = doc_id").select(F.col("doc_id").alias("_kept_id"))
    named = docs.join(kept, docs[id_col] == kept["_kept_id"], "left_semi")
    return named.unionByName(docs.filter(F.col(id_col).isNull()))
