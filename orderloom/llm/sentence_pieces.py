"""SentencePiece ids by rounds of merges over flat symbol arrays, and texts from ids.

A block of texts is cut into words where no vocabulary entry can reach over the cut, and each distinct word of the block
is merged once, by the rounds of `merging`.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import text_or_empty
from orderloom.llm.merging import Rounds

BLOCK_BYTES = 6_000_000  # texts are taken in blocks of about so many bytes; a longer text is a block alone
MARK = "▁"  # how the vocabulary writes a space
# Fixed values of the model format
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PAIR_MODEL = 2

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class MergeRounds:
    """Encodes and decodes as a SentencePiece model file of the pair-merging kind does."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        plain = (model.trainer_spec.model_type == PAIR_MODEL and model.trainer_spec.byte_fallback
                 and not model.trainer_spec.treat_whitespace_as_suffix and rules.add_dummy_prefix
                 and not rules.remove_extra_whitespaces and rules.escape_whitespaces
                 and not rules.precompiled_charsmap and {p.type for p in model.pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE})
        if not plain:
            raise ValueError("only pair-merging models with byte fallback and plain text rules can be read")
        kinds = np.array([p.type for p in model.pieces])
        written = [p.piece.replace(MARK, " ") for p in model.pieces]
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        normal = {p: i for i, p in enumerate(written) if kinds[i] == NORMAL}
        scores = np.array([p.score for p in model.pieces])
        levels = np.unique(-scores[kinds == NORMAL])
        self.rank = np.searchsorted(levels, -scores).astype(np.int32)
        self.symbol = np.full(0x110000, self.unknown, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.byte_id = np.zeros(256, np.int32)
        surfaces = [p.encode() for p in written]
        for i in np.flatnonzero(kinds == BYTE):
            value = int(model.pieces[i].piece[1:-1], 16)
            self.byte_id[value] = i
            surfaces[i] = bytes([value])
        for i in np.flatnonzero(kinds == CONTROL):
            surfaces[i] = b""
        surfaces[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.surfaces = pa.array(surfaces, pa.large_binary())
        self.hidden = kinds == CONTROL
        self.begins_blank = np.array([k == NORMAL and p[:1] == " " for k, p in zip(kinds, written)])
        self.rounds = self._pairs(normal)
        self._cuts(normal)

    def _pairs(self, normal: dict[str, int]) -> Rounds:
        """Every two pieces that make a third; a pair is as good as the piece it makes."""
        lefts, rights, made = [], [], []
        get = normal.get
        for p, i in normal.items():
            for k in range(1, len(p)):
                left = get(p[:k])
                if left is not None and (right := get(p[k:])) is not None:
                    lefts.append(left)
                    rights.append(right)
                    made.append(i)
        return Rounds(lefts, rights, made, self.rank[made])

    def _cuts(self, normal: dict[str, int]) -> None:
        """Between which bytes a text may be cut: those that stand side by side in no piece."""
        joined = np.zeros(65536, bool)
        for p in normal:
            data = np.frombuffer(p.encode(), np.uint8).astype(np.int64)
            joined[data[:-1] * 256 + data[1:]] = True
        inside = np.arange(65536) & 0xC0 == 0x80
        self.may_cut = ~joined & ~inside
        # Runs of blanks: where they are merged last, all at one rank and so from the left, and the first `run` blanks
        # always end as the longest piece, a run can be cut after each `run` blanks before its last.
        blanks = {len(p): int(self.rank[i]) for p, i in normal.items() if not p.strip(" ")}
        longest = max(blanks, default=1)
        last = longest > 1 and {r for n, r in blanks.items() if n > 1} == {int(self.rank[list(normal.values())].max())}
        alone = not any(p.startswith("  ") and p.strip(" ") for p in normal)
        self.run = longest if last and alone and all(
            _folded(n, blanks) == [longest, *_folded(n - longest, blanks)] for n in range(longest, 6 * longest)) else None

    def _blank_cuts(self, data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
        """Places inside long runs of blanks where a word may end."""
        blank = data == 32
        begins = np.flatnonzero(blank & ~np.concatenate([[False], blank[:-1]]))
        ends = np.flatnonzero(blank & ~np.concatenate([blank[1:], [False]])) + 1
        inner = np.unique(doc_starts[(doc_starts > 0) & (doc_starts < len(data))])
        inner = inner[blank[inner] & blank[inner - 1]]  # a text's first blank ends the run of the text before
        begins, ends = np.sort(np.concatenate([begins, inner])), np.sort(np.concatenate([ends, inner]))
        sizes = (ends - begins - 1) // self.run
        nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        return np.repeat(begins, sizes) + nth * self.run

    def encode(self, texts: list[str], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each text followed by ``end``; and the number of ids per text."""
        raw = [(" " + t).replace(MARK, " ").encode() if t else b"" for t in texts]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        starts = np.concatenate([[0], ends[:-1]])
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = self.may_cut[data[:-1].astype(np.uint16) << 8 | data[1:]]
            if self.run and b" " * (self.run + 1) in joined:
                cut[self._blank_cuts(data, starts)] = True
            cut[starts] = True
            cut[ends] = True
        offsets = np.flatnonzero(cut)
        if not len(data):
            offsets = np.zeros(1, np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]).dictionary_encode()
        table, sizes = self._encode_words(words.dictionary)
        table = np.append(table, np.int32(0 if end is None else end))
        bounds = np.concatenate([[0], np.cumsum(np.append(sizes, 0 if end is None else 1))])
        behind = np.searchsorted(offsets, ends)  # words up to the end of each text
        codes = np.insert(words.indices.to_numpy(zero_copy_only=False), behind, len(sizes))
        entries = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
            None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(table.tobytes())])
        taken = entries.take(pa.array(codes))
        places = np.frombuffer(taken.buffers()[1], np.int64)[:len(codes) + 1] // 4
        flat = np.frombuffer(taken.buffers()[2] or b"", np.int32)[:places[-1]]
        return flat, np.diff(places[behind + np.arange(1, len(texts) + 1)], prepend=0)

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, and the number of ids of each."""
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        raw = words.buffers()[2].to_pybytes()[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        data = np.frombuffer(raw, np.uint8)
        heads = np.flatnonzero(data & 0xC0 != 0x80)
        per_word = np.diff(np.searchsorted(heads, bounds))
        symbols = self.symbol[np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")]
        word = np.repeat(np.arange(len(words)), per_word)
        final = self.rounds.merge(symbols, word)
        kept = np.flatnonzero(final >= 0)
        pieces, word = final[kept], word[kept]
        lost = pieces == self.unknown  # always a single character
        spans = np.where(lost, np.diff(heads, append=len(data))[kept], 1)
        ids = np.repeat(pieces, spans)
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(spans) - spans, spans)
        spelt = np.repeat(lost, spans)
        ids[spelt] = self.byte_id[data[(np.repeat(heads[kept], spans) + inside)[spelt]]]
        return ids, np.bincount(word, spans, len(words)).astype(np.int64)

    def decode(self, flat: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The text of each run of ids. Bytes on both sides of a control id count as one run of bytes."""
        taken = self.surfaces.take(pa.array(flat.astype(np.int64)))
        places = np.frombuffer(taken.buffers()[1], np.int64)[:len(flat) + 1]
        data = (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        ends = np.cumsum(lengths)
        shown = np.flatnonzero(~self.hidden[flat])
        nth = np.searchsorted(shown, ends - lengths)
        first = shown[np.minimum(nth, max(len(shown) - 1, 0))] if len(shown) else np.zeros(len(ends), np.int64)
        blank = (nth < len(shown)) & (first < ends)
        blank[blank] = self.begins_blank[flat[first[blank]]]
        lo, hi = places[ends - lengths] + blank, places[ends]
        return [data[a:b].decode("utf-8", "each-byte") for a, b in zip(lo.tolist(), hi.tolist())]


def _folded(n: int, lengths: dict[int, int]) -> list[int]:
    """A run of ``n`` blanks after merges of the leftmost pair whose joint length is in ``lengths``."""
    run = [1] * n
    while True:
        at = next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in lengths), None)
        if at is None:
            return run
        run[at:at + 2] = [run[at] + run[at + 1]]


def _blocks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _lists(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.array(flat, pa.int32()))


def encode_texts(docs: DataFrame, model: str, end: int | None, decoded: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row, and with ``decoded`` also the text that the ids give back.

    Null and empty texts hold the end id alone (no ids without one) and give back an empty text. Every row is encoded by
    itself, so rows that repeat, also under one id, come as often as they are there; a null id stays null. An empty
    table gives no rows. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = MergeRounds(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for block in _blocks(texts):
                flat, lengths = rounds.encode(texts[block], end)
                columns = [batch.column(0)[block.start:block.stop], _lists(flat, lengths)]
                if decoded:
                    columns.append(pa.array(rounds.decode(flat, lengths), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string" if decoded else ""))


def decode_ids(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of every row of ids. Null and empty lists, and control ids, give no text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = MergeRounds(model)
        for batch in batches:
            lists = batch.column(1)
            texts = rounds.decode(lists.flatten().to_numpy(zero_copy_only=False),
                                  pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    ids = F.coalesce(F.filter(F.col(ids_col).cast("array<int>"), lambda x: x.isNotNull()), F.array().cast("array<int>"))
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, decoded string")
