"""Token ids of whole texts, with each distinct piece of text encoded once per task.

A word-level tokenizer never lets a token reach over a space, so a text's ids are those of its pieces one after the
other. Pieces repeat, and a dictionary of them costs far less than encoding each again.
"""

from __future__ import annotations

import json
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

from orderloom.llm.merging import Rounds

CACHE_PIECES = 400_000  # the dictionary starts anew beyond this; a bound on memory, without effect on the ids
BLOCK_CHARS = 4_000_000  # texts are encoded in blocks of about so many characters; a longer text is a block alone

WHITE_BYTE = np.zeros(256, bool)
WHITE_BYTE[[*range(0x09, 0x0E), 0x20]] = True
BREAK = np.zeros(256, bool)
BREAK[[0x20, 0x0A]] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

SEPARATOR = "\ue000"  # a private-use character, set between pieces that are encoded together
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what tokenizers call white space


# tokenizers cut between letters and marks, so such a piece is its line break, its word and its marks
WORD_AND_MARKS = re.compile("(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?*#$%&|]*)")
# byte-level vocabularies write a byte that is no printable Latin-1 character as one of the characters from 256 on
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = dict(zip((b for b in range(256) if b not in PRINTABLE), map(chr, range(256, 512))))


# texts on which a file that cuts by other rules would show
PROBES = ("Hello, World!", "don't  stop", " a\nb\r\nc ", "x1 22 333", "Ünder straße ÉTÉ", "日本 語", "a.b,c;d", "tab\there",
          "UPPER lower MiXed", "", " ", "\n\n", "’quoted’ – dash", "word… end", "naïve café")


class PieceEncoder:
    """Encodes lists of texts with a tokenizer file of the tokenizers library.

    ``spaced`` is true for byte-level files, where a space belongs to the word after it, and false where white space
    is dropped. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, spaced: bool):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit in 16 bits")
        self.spaced = spaced
        self._read_model(path)
        self.mark = self._plain(" " + SEPARATOR) if spaced else self._plain(SEPARATOR)
        # white space next to white space may be one token, and \x01 marks the first piece below
        self.uneven = re.compile(f"[{WHITE}][{WHITE}]|\x01|^[{WHITE}]|[{WHITE}]$")
        self.general = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self._clear()
        self._try_out()

    def _try_out(self) -> None:
        """Files with other rules for white space, letters or marks would give other ids: compare with the library."""
        flat, lengths = self.encode(list(PROBES), 0)
        for ids, probe in zip(np.split(flat, np.cumsum(lengths)[:-1]), PROBES):
            if ids[:-1].tolist() != self._plain(probe):
                raise ValueError(f"this tokenizer file cuts texts by other rules: {probe!r}")

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)  # the ids of piece i are pool[starts[i]:starts[i + 1]]
        self.pool = np.zeros(0, np.uint16)

    def _is_uneven(self, texts: list[str], data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts have white space at an end or side by side, or a \\x01; their pieces take a closer look."""
        starts = np.concatenate([[0], ends[:-1]])
        white = np.concatenate([WHITE_BYTE[data], [False]])
        double = np.flatnonzero(white[:-1] & white[1:])
        owner = np.searchsorted(ends, double, "right")
        double = owner[double + 1 < ends[owner]]
        out = np.zeros(len(texts), bool)
        out[double] = True
        out[np.searchsorted(ends, np.flatnonzero(data == 1), "right")] = True
        full = ends > starts
        out[full] |= white[starts[full]] | white[ends[full] - 1]
        # white space beyond ASCII begins with one of these bytes, and so does much else
        wide = np.flatnonzero(np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3)))
        for i in np.unique(np.searchsorted(ends, wide, "right")).tolist():
            out[i] = out[i] or self.uneven.search(texts[i]) is not None
        return out

    def _cut(self, texts: list[str]) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray]:
        """The distinct pieces of all texts as bytes, those of uneven texts behind them as text, the number of the piece
        at each place, and the pieces of each text."""
        raw = [t.encode() for t in texts]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        uneven = self._is_uneven(texts, data, ends) if self.spaced else np.zeros(len(texts), bool)
        breaks = BREAK[data]
        cut = np.zeros(len(data) + 1, bool)
        if self.spaced:  # a blank or a line break begins a piece
            cut[:-1] = breaks
        else:  # it ends one
            cut[1:] = breaks
        cut[0] = True
        cut[ends] = True
        offsets = np.flatnonzero(cut) if len(data) else np.zeros(1, np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]).dictionary_encode()
        codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.diff(np.searchsorted(offsets, ends), prepend=0)
        numbers: dict[str, int] = {}
        if uneven.any():
            parts = np.split(codes, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(uneven).tolist():
                own = ["\x01" + p for p in self.general.findall(texts[i])]
                parts[i] = np.fromiter((numbers.setdefault(p, len(numbers)) for p in own), np.int64, len(own)) + len(
                    found.dictionary)
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            codes = np.concatenate(parts)
        return found.dictionary, list(numbers), codes, counts

    def _piece(self, raw: bytes) -> str:
        """A piece of `_cut` as it is known in the dictionary."""
        text = raw.decode()
        if not self.spaced:
            return text[:-1] if text[-1:] in (" ", "\n") else text
        return text[1:] if text[:1] == " " else text if text[:1] == "\n" else "\x01" + text

    def _plain_words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces are nothing but letters (ASCII and Latin-1), their ids end to end, and the ids of each."""
        n = len(pieces)
        if not n:
            return np.zeros(0, bool), np.zeros(0, np.uint16), np.zeros(0, np.int64)
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + n + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
        starts, lengths = bounds[:-1] - bounds[0], np.diff(bounds)
        edge = starts if self.spaced else starts + lengths - 1
        edge = edge[data[edge] == 0x20] if self.spaced else edge[BREAK[data[edge]]]
        two = np.zeros(len(data) + 1, bool)  # second bytes of letters of two bytes
        two[1:] = data == 0xC3
        two = two[:-1] & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        fine = ASCII_LETTER[data] | two
        fine[:-1] |= two[1:]
        fine[edge] = True
        simple = np.logical_and.reduceat(fine, starts)
        mine = np.repeat(simple, lengths)
        if not self.spaced:
            lower = data + np.where((data >= 0x41) & (data <= 0x5A) | two & (data <= 0x9E), 0x20, 0).astype(np.uint8)
            data = lower
            mine[edge] = False
        at = np.flatnonzero(mine)
        word = np.repeat(np.arange(n), lengths)[at]
        symbols = self.inner[data[at]]
        last = np.flatnonzero(np.concatenate([word[1:] != word[:-1], [True]])) if len(at) else at
        symbols[last] = self.last[data[at[last]]]
        final = self.rounds.merge(symbols, word)
        kept = np.flatnonzero(final >= 0)
        return simple, final[kept].astype(np.uint16), np.bincount(word[kept], minlength=n)

    def _written(self, piece: str) -> str:
        """A piece as it stands in the text."""
        if not self.spaced:
            return piece
        if piece[:1] == "\x01":
            return piece[1:]
        return piece if piece[:1] == "\n" else " " + piece

    def _add(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.index)
        self.index.update(zip(pieces, range(first, first + len(pieces))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.pool = np.concatenate([self.pool, flat])

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, and the place behind each piece."""
        sizes = (self.starts[1:] - self.starts[:-1])[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(self.starts[codes] - (ends - sizes), sizes)], ends

    def _read_model(self, path: str) -> None:
        """The pairs of the model file, and the symbols that the bytes of a word begin as."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        kept = [(a, b, r) for r, (a, b) in enumerate(pairs) if a + b in vocab]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get(
                "ignore_merges") or model.get("dropout") or len(kept) != len(pairs):
            raise ValueError("only plain pair-merging models can be read")
        lefts, rights = [vocab[a] for a, _, _ in kept], [vocab[b] for _, b, _ in kept]
        self.rounds = Rounds(lefts, rights, [vocab[a + b] for a, b, _ in kept], [r for _, _, r in kept])
        names = [BYTE_NAMES.get(b, chr(b)) for b in range(256)]
        self.inner = np.array([vocab[n] for n in names], np.int32)
        self.last = np.array([vocab[n + end] for n in names], np.int32)

    def _add_words(self, words: list[str]) -> None:
        """Pieces of letters, by merges alone: nothing is left to normalise or to cut."""
        if not words:
            return
        raw = [(self._written(w) if self.spaced else w.lower()).encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        final = self.rounds.merge(symbols, word)
        kept = np.flatnonzero(final >= 0)
        self._add(words, final[kept].astype(np.uint16), np.bincount(word[kept], minlength=len(words)))

    def _learn(self, pieces: list[str]) -> None:
        """Add pieces. A word with a line break or marks is put together from the ids of its parts."""
        match, prefix = WORD_AND_MARKS.fullmatch, "\x01" if self.spaced else ""
        words, others, made, parts, counts = {}, {}, [], [], []
        for p in pieces:
            cut = match(p)
            if cut is None:
                others[p] = None
                continue
            line, word, marks = cut.groups()
            if not line and not marks:
                words[p] = None
                continue
            before = len(parts)
            if line:
                others["\x01\n"] = None
                parts.append("\x01\n")
                word = "\x01" + word
            words[word] = None
            parts.append(word)
            if marks:
                others[prefix + marks] = None
                parts.append(prefix + marks)
            made.append(p)
            counts.append(len(parts) - before)
        self._add_words([w for w in words if w not in self.index])
        self._encode_new([p for p in others if p not in self.index])
        if made:
            flat, ends = self._gather(np.fromiter(map(self.index.get, parts), np.int64, len(parts)))
            behind = ends[np.cumsum(counts) - 1]
            self._add(made, flat, np.diff(behind, prepend=0))

    def _encode_new(self, pieces: list[str]) -> None:
        if not pieces:
            return
        texts = [self._written(p) for p in pieces]
        alone = [SEPARATOR in t or (self.spaced and (t[:1] not in (" ", "\n") or t[-1:].isspace())) for t in texts]
        ids: list[np.ndarray | None] = [None] * len(texts)
        together = [i for i, a in enumerate(alone) if not a]
        if together:
            gap = " " + SEPARATOR if self.spaced else " " + SEPARATOR + " "
            joined = np.array(self._plain(gap.join(texts[i] for i in together)), np.uint16)
            width = len(self.mark)
            hit = np.ones(max(len(joined) - width + 1, 0), bool)
            for k, token in enumerate(self.mark):
                hit &= joined[k:len(joined) - width + 1 + k] == token
            at = np.flatnonzero(hit)
            if len(at) != len(together) - 1:
                raise ValueError("pieces were not told apart")
            lo = np.concatenate([[0], at + width])
            hi = np.concatenate([at, [len(joined)]])
            for i, a, b in zip(together, lo, hi):
                ids[i] = joined[a:b]
        rest = [i for i, a in enumerate(alone) if a]
        for i, e in zip(rest, self.tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            ids[i] = np.array(e.ids, np.uint16)
        self._add(pieces, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text followed by ``end``, as one array; and the number of ids of each text."""
        if len(self.index) > CACHE_PIECES:
            self._clear()
        if not texts:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        words, uneven, places, counts = self._cut(texts)
        simple, plain, sizes = self._plain_words(words)
        # what is no plain word is known from before or learned; pieces of uneven texts count as they were cut last
        needed = np.zeros(len(words) + len(uneven), bool)
        needed[places] = True
        rest = np.flatnonzero(needed[:len(words)] & ~simple)
        pieces = [self._piece(w) for w in words.take(pa.array(rest)).to_pylist()] + uneven
        known = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        if len(new := np.flatnonzero(known < 0)):
            unknown = [pieces[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            known[new] = np.fromiter(map(self.index.get, unknown), np.int64, len(unknown))
        others, behind = self._gather(known)
        sizes = np.concatenate([sizes, np.zeros(len(uneven), np.int64)])
        begins = np.cumsum(sizes) - sizes
        slots = np.concatenate([rest, np.arange(len(words), len(words) + len(uneven))])
        sizes[slots] = np.diff(behind, prepend=0)
        begins[slots] = len(plain) + behind - sizes[slots]
        pool = np.concatenate([plain, others])
        per_place = sizes[places]
        ends = np.cumsum(per_place)
        total = int(ends[-1]) if len(ends) else 0
        flat = pool[np.arange(total) + np.repeat(begins[places] - (ends - per_place), per_place)]
        last_piece = np.cumsum(counts)
        text_ends = np.concatenate([[0], ends])[last_piece]
        lengths = np.diff(text_ends, prepend=0) + 1
        return np.insert(flat, text_ends, end), lengths


def blocks(texts: list[str]):
    """Slices of a list of texts with about BLOCK_CHARS characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))
