"""Language of words and texts by a linear-chain conditional random field.

Every word of a text has a language as its label. What speaks for a label are affixes, character n-grams and the word
itself (hashed features with learned weights); neighbouring labels are tied by learned transitions. The model is
fitted on pieces of labelled texts joined to code-switched sequences, so it learns how long languages last, and
forward-backward gives each word's label probabilities. A text has the language that most of its letters are in.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from orderloom.llm.common import staged
from orderloom.llm.words import mixed

FEATURES = 1 << 16
DOCS_PER_LANGUAGE = 200  # the sample that the model is fitted on: so many texts of each language,
PIECES_PER_DOC, PIECE_WORDS = 24, 20  # so many pieces from all over each text, of up to so many words
LISTED = 3  # so often a word comes in the sample of a language to be in its list
EPOCHS, RATE, DECAY = 3, 0.4, 1e-6
CACHE_WORDS = 250_000  # a bound on memory, without effect on results
BLOCK_CHARS = 6_000_000
UNKNOWN = "und"
# what ends a word: ASCII white space, with the four separators from \x1c on, and these characters
SPACE = np.zeros(256, bool)
SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # of each feature for each label
    transitions: np.ndarray  # log weights, from the row's label to the column's
    lexicon: dict[str, int]  # listed words, with a bit per label


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def letters_in(lowered: list[str]) -> list[str]:
    """What is left of each word without the characters that are no letters."""
    return [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in lowered]


def _hashed(kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind, np.uint64)
    for part in parts:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + part)
    return (h % np.uint64(FEATURES)).astype(np.int64)


def features_of(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all words, word after word, their number per word, and the letters of each word. Features are the
    word itself, affixes of one to three letters, n-grams of two and three with the word's edges, and the languages whose
    list holds the word. All but the last are hashed. A word without letters has none. Words hold no white space."""
    lowered = "\n".join(words).lower().split("\n") if words else []
    cleaned = letters_in(lowered)
    sizes = np.fromiter(map(len, cleaned), np.int64, len(cleaned))
    letters = np.frombuffer("".join(cleaned).encode("utf-32-le"), "<u4").astype(np.uint64)
    some = np.flatnonzero(sizes)
    n = sizes[some]
    begins = np.cumsum(n) - n
    owners, features = [], []

    def add(owner: np.ndarray, values: np.ndarray) -> None:
        owners.append(owner)
        features.append(values)

    owner = np.repeat(np.arange(len(some)), n)
    place = np.arange(len(letters)) - np.repeat(begins, n)
    # the word itself: its letters under multipliers of their places
    whole = mixed(letters * (mixed(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)))
    add(np.arange(len(some)), _hashed(1, np.add.reduceat(whole, begins) if len(some) else whole))
    for k in (1, 2, 3):
        long = np.flatnonzero(n >= k)
        add(long, _hashed(10 + k, *[letters[begins[long] + i] for i in range(k)]))
        add(long, _hashed(20 + k, *[letters[begins[long] + n[long] - k + i] for i in range(k)]))
    # n-grams, with 1 for the edge before a word and 2 for the one behind it
    edged = np.full(len(letters) + 2 * len(some), 2, np.uint64)
    edged[begins + 2 * np.arange(len(some))] = 1
    edged[np.arange(len(letters)) + 2 * owner + 1] = letters
    owner = np.repeat(np.arange(len(some)), n + 2)
    for k in (2, 3):
        at = np.flatnonzero(owner[k - 1:] == owner[:len(owner) - k + 1]) if len(owner) >= k else np.zeros(0, np.int64)
        add(owner[at], _hashed(30 + k, *[edged[at + i] for i in range(k)]))
    listed = np.fromiter(map(lexicon.get, lowered, repeat(0)), np.int64, len(lowered))[some]
    for j in range(int(listed.max(initial=0)).bit_length()):
        hit = np.flatnonzero(listed >> j & 1)
        add(hit, np.full(len(hit), FEATURES + j))
    owner, flat = np.concatenate(owners), np.concatenate(features)
    by = np.argsort(owner, kind="stable")
    counts = np.zeros(len(words), np.int64)
    counts[some] = np.bincount(owner, minlength=len(some))
    return flat[by], counts, sizes


def scores_of(words: list[str], weights: np.ndarray, lexicon: dict[str, int]) -> np.ndarray:
    """The summed feature weights of each word for each label, zero for a word without letters; and its letters."""
    flat, counts, letters = features_of(words, lexicon)
    k = weights.shape[1]
    out = np.zeros((len(words), k + 1), np.float32)
    some = counts > 0
    if some.any():
        out[some, :k] = np.add.reduceat(weights[flat], (np.cumsum(counts) - counts)[some], axis=0)
        out[some, :k] /= np.sqrt(counts[some])[:, None]
    out[:, k] = letters
    return out


def lexicon_of(pieces: list[tuple[str, list[str]]], labels: list[str]) -> dict[str, int]:
    """Words in lower case with a bit for each language in whose sample they come LISTED times or more."""
    seen: Counter = Counter()
    for label, words in pieces:
        seen.update((label, w.lower()) for w in words if letters_of(w))
    bit = {label: 1 << j for j, label in enumerate(labels)}
    lexicon: dict[str, int] = {}
    for (label, word), times in seen.items():
        if times >= LISTED:
            lexicon[word] = lexicon.get(word, 0) | bit[label]
    return lexicon


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words as white space ends them: the distinct ones, their number at each place, and the words of each text."""
    raw = [(t if t.isascii() else WIDE_SPACE.sub(" ", t)).encode() for t in texts]
    joined = b" ".join([b"", *raw, b""])
    inside = ~SPACE[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # where a word begins or ends, in turn
    starts = edges[::2]
    counts = np.diff(np.searchsorted(starts, np.cumsum([1] + [len(r) + 1 for r in raw])))
    if not len(edges):
        return [], np.zeros(0, np.int64), counts
    found = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [
        None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(joined)]).dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False)[::2]
    used = np.zeros(len(found.dictionary), bool)
    used[codes] = True
    number = np.cumsum(used) - 1
    return found.dictionary.filter(pa.array(used)).cast(pa.string()).to_pylist(), number[codes], counts


def time_major(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences end to end: where each item stands if items are ordered by their place in the sequence and then
    by falling length of the sequence; and where each place begins in that order."""
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    active = np.bincount(place, minlength=1) if len(place) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(active)])
    return begins[place] + np.repeat(rank, counts), begins


def forward_backward(scores: np.ndarray, begins: np.ndarray, transitions: np.ndarray,
                     pairs: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every item of sequences in the order of `time_major`; all sequences step together, and
    the longer ones go on alone. Every step is scaled to sum to one, in the precision of ``scores``. ``pairs`` is increased by the expected number of each transition."""
    kind = scores.dtype
    step = np.exp(transitions - transitions.max()).astype(kind)
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    edges = begins.tolist()
    ahead = np.empty_like(local)
    for t in range(len(edges) - 1):
        a, b = edges[t], edges[t + 1]
        now = local[a:b] if t == 0 else (ahead[edges[t - 1]:edges[t - 1] + b - a] @ step) * local[a:b]
        ahead[a:b] = now / now.sum(axis=1, keepdims=True)
    out = ahead.copy()
    behind = None
    for t in range(len(edges) - 2, -1, -1):
        a, b = edges[t], edges[t + 1]
        if behind is not None:
            longer = len(behind)
            own = out[a:a + longer]
            if pairs is not None:
                joint = ahead[a:a + longer, :, None] * step * behind[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = behind @ step.T
            back /= back.sum(axis=1, keepdims=True)
            own *= back
            own /= own.sum(axis=1, keepdims=True)
            rest = np.ones((b - a, step.shape[0]), kind)
            rest[:longer] = back
            behind = rest * local[a:b]
        else:
            behind = local[a:b].copy()
    return out


def fit(pieces: list[tuple[str, list[str]]], sequences_drawn: int | None = None, seed: int = 5) -> Model | None:
    """The model of pieces (language, words), by stochastic gradient steps on the likelihood of label sequences. Of one
    to three pieces each, as many sequences are drawn as there are pieces, or ``sequences_drawn``."""
    by_label: dict[str, list[list[str]]] = {}
    for label, words in sorted(pieces):
        by_label.setdefault(label, []).append(words)
    labels = sorted(by_label)
    if not labels:
        return None
    rng = random.Random(seed)
    k = len(labels)
    index: dict[str, int] = {}
    sequences = []
    for _ in range(len(pieces) if sequences_drawn is None else sequences_drawn):
        words, tags = [], []
        for _ in range(rng.choice([1, 1, 2, 3])):
            label = rng.randrange(k)
            own = rng.choice(by_label[labels[label]])
            words += [index.setdefault(w, len(index)) for w in own]
            tags += [label] * len(own)
        sequences.append((np.array(words, np.int64), np.array(tags, np.int64)))
    lexicon = lexicon_of(pieces, labels)
    flat, counts, _ = features_of(list(index), lexicon)
    starts = np.cumsum(counts) - counts
    width = FEATURES + k
    weights, transitions = np.zeros((width, k)), np.zeros((k, k))
    seen, seen_steps = np.full((width, k), 1e-3), np.full((k, k), 1.0)
    for _ in range(EPOCHS):
        rng.shuffle(sequences)
        for at in range(0, len(sequences), 100):
            batch = sequences[at:at + 100]
            words, tags = (np.concatenate(x) for x in zip(*batch))
            own = counts[words]
            owner = np.repeat(np.arange(len(words)), own)
            feats = flat[np.arange(len(owner)) + np.repeat(starts[words] - (np.cumsum(own) - own), own)]
            scale = 1 / np.sqrt(np.maximum(own, 1))
            scores = np.stack([np.bincount(owner, weights[feats, j], len(words)) for j in range(k)], 1) * scale[:, None]
            sizes = np.array([len(w) for w, _ in batch])
            place, begins = time_major(sizes)
            ordered = np.empty_like(scores)
            ordered[place] = scores
            expected = np.zeros((k, k))
            gap = -forward_backward(ordered, begins, transitions, expected)[place]
            gap[np.arange(len(tags)), tags] += 1
            inside = np.ones(len(tags), bool)
            inside[np.cumsum(sizes) - 1] = False
            real = np.zeros((k, k))
            np.add.at(real, (tags[:-1][inside[:-1]], tags[1:][inside[:-1]]), 1)
            gap *= scale[:, None]
            grad = np.stack([np.bincount(feats, gap[owner, j], width) for j in range(k)], 1) - DECAY * weights
            seen += grad ** 2
            weights += RATE * grad / np.sqrt(seen)
            seen_steps += (real - expected) ** 2
            transitions += RATE * (real - expected) / np.sqrt(seen_steps)
    return Model(labels, weights.astype(np.float32), transitions, lexicon)


def sample_pieces(docs: DataFrame, may_learn: Column, id_col: str, text_col: str, lang_col: str) -> list:
    """Pieces of up to DOCS_PER_LANGUAGE texts of each language, chosen by a hash of the id, from all over the text."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for label, text in zip(batch["_label"], batch["_text"]):
                words = text.split()
                rng = random.Random(zlib.crc32(text.encode()))
                for _ in range(min(PIECES_PER_DOC, 1 + len(words) // PIECE_WORDS)):
                    at = rng.randrange(max(1, len(words) - PIECE_WORDS // 2))
                    own = words[at:at + rng.randint(3, PIECE_WORDS)]
                    if any(letters_of(w) for w in own):
                        out.append((label, " ".join(own)))
            yield pd.DataFrame(out, columns=["label", "words"], dtype=object)

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(lang_col).cast("string").alias("_label"),
                       F.col(text_col).cast("string").alias("_text"), may_learn.alias("_may"))
    known = rows.filter("_may and _label is not null and _id is not null and _text is not null")
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id")
    picked = (known.select("_id", "_label").withColumn("_n", F.row_number().over(order))
              .filter(F.col("_n") <= DOCS_PER_LANGUAGE).select("_id", "_label").distinct())
    # the number of languages bounds this side
    chosen = known.join(F.broadcast(staged(picked, "sampled-texts")), ["_id", "_label"])
    found = chosen.mapInPandas(cut, "label string, words string").collect()
    return [(r.label, r.words.split()) for r in found]


def label_texts(texts: list[str], model: Model, index: dict[str, int], table: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best label of each text (-1 without letters), the share of its letters, and the table of word scores and
    letters by the numbers in ``index``, with the new words."""
    words, places, counts = words_of(texts)
    codes = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
    k = len(model.labels)
    if len(new := np.flatnonzero(codes < 0)):
        fresh = [words[i] for i in new.tolist()]
        codes[new] = np.arange(len(table), len(table) + len(fresh))
        index.update(zip(fresh, codes[new].tolist()))
        table = np.concatenate([table, scores_of(fresh, model.weights, model.lexicon)])
    total = np.zeros((len(texts), k))
    if len(places):
        rows = codes[places]
        place, begins = time_major(counts)
        ordered = np.empty((len(rows), k), np.float32)
        ordered[place] = table[rows, :k]
        share = forward_backward(ordered, begins, model.transitions)[place]
        share *= table[rows, k:]
        full = counts > 0
        total[full] = np.add.reduceat(share, (np.cumsum(counts) - counts)[full], axis=0, dtype=np.float64)
    mass = total.sum(axis=1)
    best = total.argmax(axis=1)
    score = np.where(mass > 0, total[np.arange(len(texts)), best] / np.maximum(mass, 1e-30), 0.0)
    return np.where(mass > 0, best, -1), np.clip(score, 0, 1), table


def predicted(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score`` of their column ``text``, all other columns beside them."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.labels, model.weights, model.transitions, model.lexicon) if model else None)
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value) if shared.value else None
        index: dict[str, int] = {}
        table = np.zeros((0, len(model.labels) + 1 if model else 1), np.float32)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            # texts of like lengths go together, so that the steps of a long one are not taken by every block
            order = sorted(range(len(texts)), key=lambda i: len(texts[i])) if model else []
            start, size = 0, 0
            for i, nth in enumerate(order):
                size += len(texts[nth])
                if size > BLOCK_CHARS or i == len(order) - 1:
                    own = order[start:i + 1]
                    if len(index) > CACHE_WORDS:
                        index, table = {}, table[:0]
                    best[own], score[own], table = label_texts([texts[j] for j in own], model, index, table)
                    start, size = i + 1, 0
            names = pa.array([model.labels[i] if i >= 0 else UNKNOWN for i in best.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names, pa.array(score)],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema)


def learned(docs: DataFrame, held_out: Column | None, id_col: str, text_col: str, lang_col: str,
            sequences_drawn: int | None = None) -> tuple[Model | None, Column]:
    """The model, and which rows are held out."""
    if held_out is None:
        held_out = F.crc32(F.col(id_col).cast("string")) % 4 == 2
    held_out = F.coalesce(held_out, F.lit(False))
    return fit(sample_pieces(docs, ~held_out, id_col, text_col, lang_col), sequences_drawn), held_out


def identify(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", sequences_drawn: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    The model learns from texts with a language that are not ``held_out`` (by default a quarter: those whose CRC-32 of
    the id as text leaves 2 when divided by 4). ``score`` is the share of the text's letters that are in the predicted
    language, in expectation. Words end at white space.

    A null text and one without a letter is "und" with score 0, as is every text if there is nothing to learn from.
    A row with a null id is not held out and not learned from. Rows that repeat get the same answer. An empty table
    gives no rows. Other columns are not read.
    """
    model, held_out = learned(docs, held_out, id_col, text_col, lang_col, sequences_drawn)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return predicted(rows, model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in some language by at least ``least`` of its letters; rejected are texts
    without letters and mixtures in which no language reaches that. A null language becomes the predicted one. Every row
    is judged by its own text, whatever its id: null ids stay null, and of rows that share an id each is judged alone."""
    model, _ = learned(docs, None, id_col, text_col, lang_col)
    # the columns travel beside the text, under names that nothing else has
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(text_col).cast("string").alias("text"))
    found = predicted(rows, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[(F.coalesce(F.col(n), F.col("lang_pred")) if c == lang_col else F.col(n)).alias(c)
                          for c, n in names.items()])
