"""Encoding with a merge-type SentencePiece vocabulary, and decoding.

The encoder keeps the adjacent pairs of symbols that form a piece in an agenda
ordered by score, then by place, and joins the best pair until none is left.
Short words go through it side by side: a row of a matrix has the ranks of one
word's pairs, and each step joins the best pair of every row.  No piece of a merge vocabulary that respects white space has the space mark
after another sign, so pairs never join across the start of a word: a text is
cut there and each distinct word is encoded once per worker.  The vocabulary is
tested for this property; without it whole texts go through the agenda.

What the agenda gives is checked against the library in each Arrow batch, word
by word or text by text; a difference is an error, never a silent result.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import bounded_batches, handing_back, keep

MARK = "▁"
#: Words kept per worker (as many are those of the cache before), and the longest that is kept.
CACHE_WORDS, CACHE_CHARS = 150_000, 64
#: Signs of text whose new words are looked for together, for each word that is kept.
BLOCK_SHARE = 10
#: New words that are encoded together.
NEW_WORDS = 20_000
#: Words are put side by side with others of up to the same of these lengths.
LENGTHS = (4, 7, 10, 13, 16, 20, 25, 32, 48, CACHE_CHARS)

#: Tasks that use a worker's codec again.
PURPOSE = "codec"

#: The ids of a word.
Entry = Sequence[int]

RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@contextmanager
def _without_collections() -> Iterator[None]:
    """Many new lists and no cycles: looking for garbage among them would cost a tenth of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class PieceCodec:
    """Ids of texts by the vocabulary of a SentencePiece model file."""

    def __init__(self, model_file: str, check: str = "words", cache_words: int = CACHE_WORDS) -> None:
        if check not in ("words", "texts", "none"):
            raise ValueError(f"check must be words, texts or none: {check}")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        self.check = check
        self.cache_words = cache_words
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes = [lib.unk_id()] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.pieces[piece] = (lib.get_score(i), i)
        self.cuts_at_mark = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self._kept: dict[str, Entry] = {}
        self._old: dict[str, Entry] = {}
        self._decimal = [str(i) for i in range(lib.get_piece_size())]
        #: One object per id, so that kept words share them.
        self._numbers = list(range(lib.get_piece_size()))
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Numbers all signs and pieces, and lists the pairs of them that form a piece."""
        names = list(dict.fromkeys([*self.pieces, *(c for p in self.pieces for c in p)]))
        number = {name: i for i, name in enumerate(names)}
        #: A last symbol stands for signs that no piece has; it pairs with none.
        self._symbols = len(names) + 1
        #: The symbol of each code point, and the code points that a symbol has.
        self._of_sign = np.full(0x110000, self._symbols - 1, dtype=np.int32)
        for name, i in number.items():
            if len(name) == 1:
                self._of_sign[ord(name)] = i
        self._signs = [len(name) for name in names] + [1]
        self._id_of = np.array([self.pieces[n][1] if n in self.pieces else -1 for n in names] + [-1])
        ranks = {score: r for r, score in enumerate(sorted({s for s, _ in self.pieces.values()}, reverse=True))}
        found = sorted(
            (number[p[:i]] * self._symbols + number[p[i:]], ranks[score], number[p])
            for p, (score, _) in self.pieces.items()
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        )
        keys, rank, joined = np.array(found, dtype=np.int64).reshape(-1, 3).T
        self._none = np.int32(len(ranks))
        self._pairs = np.append(keys, np.iinfo(np.int64).max)
        self._rank = np.append(rank, self._none).astype(np.int32)
        self._joined = np.append(joined, -1).astype(np.int32)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of the piece that each pair forms, and its place among the pairs."""
        keys = left.astype(np.int64) * self._symbols + right
        at = np.searchsorted(self._pairs, keys)
        at[self._pairs[at] != keys] = len(self._pairs) - 1
        return self._rank[at], at

    def _side_by_side(self, words: list[str]) -> list[list[int]]:
        """Ids of words of nearly the same length, with the agenda in a matrix."""
        unknown = self._symbols - 1
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = int(lengths.max())
        symbols = np.full((len(words), width), -1, dtype=np.int32)
        signs = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols[np.arange(width) < lengths[:, None]] = self._of_sign[signs]
        done: list[list[int]] = [[]] * len(words)
        rows = np.arange(len(words))
        # A negative symbol fills up the row: its keys are those of no pair.
        filled = np.where(symbols < 0, unknown, symbols)
        ranks, _ = self._look_up(filled[:, :-1], filled[:, 1:])
        while len(rows):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            here = np.arange(len(rows))
            live = ranks[here, best] < self._none if ranks.shape[1] else np.zeros(len(rows), dtype=bool)
            over = symbols[~live]
            ids = np.where(over < 0, -2, self._id_of[over])
            lengths = (over >= 0).sum(axis=1).tolist()
            for row, own, n in zip(rows[~live].tolist(), ids.tolist(), lengths):
                done[row] = own[:n]
            for at in np.flatnonzero((ids == -1).any(axis=1)):
                row = int(rows[~live][at])
                done[row] = self._with_bytes(words[row], over[at, : lengths[at]].tolist())
            if not live.all():
                rows, symbols, ranks, best = rows[live], symbols[live], ranks[live], best[live]
                here = np.arange(len(rows))
            if not len(rows):
                break
            n, wide = symbols.shape
            _, at = self._look_up(symbols[here, best], symbols[here, best + 1])
            symbols[here, best] = self._joined[at]
            keep = np.ones((n, wide), dtype=bool)
            keep[here, best + 1] = False
            symbols = symbols[keep].reshape(n, wide - 1)
            keep = keep[:, 1:]
            ranks = ranks[keep].reshape(n, wide - 2)
            for first in (best - 1, best):
                ok = np.flatnonzero((first >= 0) & (first < wide - 2))
                a, b = symbols[ok, first[ok]], symbols[ok, first[ok] + 1]
                ranks[ok, first[ok]] = self._look_up(a, np.where(b < 0, unknown, b))[0]
        return done

    def _with_bytes(self, word: str, symbols: list[int]) -> list[int]:
        """The ids of a word's last symbols; a sign that is no piece has those of its bytes."""
        ids: list[int] = []
        at = 0
        for symbol in symbols:
            own = int(self._id_of[symbol])
            if own >= 0:
                ids.append(own)
            else:
                ids.extend(self.bytes[b] for b in word[at].encode())
            at += self._signs[symbol]
        return ids

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word as it is, its marks included."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        groups = np.searchsorted(LENGTHS, lengths)
        for group in np.unique(groups):
            members = np.flatnonzero(groups == group).tolist()
            for at in range(0, len(members), 4096):
                part = members[at : at + 4096]
                own = [words[i] for i in part]
                found = self._side_by_side(own) if group < len(LENGTHS) else map(self._agenda, own)
                for i, ids in zip(part, found):
                    out[i] = ids
        return out

    def _agenda(self, text: str) -> list[int]:
        """Ids of a text whose spaces are marks already."""
        pieces = self.pieces
        symbols: list[str | None] = list(text)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            joined = text[i : i + 2]
            if joined in pieces:
                agenda.append((-pieces[joined][0], i, i + 1, joined))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            a, b = symbols[i], symbols[j]
            if a is None or b is None or right[i] != j or len(a) + len(b) != len(joined):
                continue  # one of the two has been joined to another meanwhile
            symbols[i], symbols[j] = joined, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                pair = joined + symbols[k]
                if pair in pieces:
                    heapq.heappush(agenda, (-pieces[pair][0], i, k, pair))
            h = left[i]
            if h >= 0:
                pair = symbols[h] + joined
                if pair in pieces:
                    heapq.heappush(agenda, (-pieces[pair][0], h, i, pair))
        ids: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            if symbol in pieces:
                ids.append(pieces[symbol][1])
            else:
                ids.extend(self.bytes[b] for b in symbol.encode())
        return ids

    def _words(self, text: str) -> list[str]:
        """The text with a mark put before it, cut before each run of marks."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if not self.cuts_at_mark:
            return [marked]
        parts = marked.split(MARK)
        if "" not in parts:
            return parts  # the usual case: single spaces, each word lacks its own mark
        words, marks = [], 0
        for part in parts:
            marks += 1
            if part:
                words.append(MARK * (marks - 1) + part)
                marks = 0
        if marks:
            words.append(MARK * (marks - 1))
        return words

    def _learn(self, texts: list[list[str]]) -> dict[str, Entry]:
        """Sees to it that all words are kept; gives those too long to be kept.

        A full cache becomes the old one, from which words in use are taken back.
        """
        kept, old = self._kept, self._old
        met = set(chain.from_iterable(texts))
        missing = [w for w in met if w not in kept]
        if not missing:
            return {}
        if len(kept) + len(missing) > self.cache_words:
            self._old, self._kept = kept, {}
            old, kept = kept, self._kept
            missing = list(met)
        new = []
        for word in missing:
            if word in old:
                kept[word] = old[word]
            else:
                new.append(word)
        long = {}
        for at in range(0, len(new), NEW_WORDS):
            for word, entry in self._entries(new[at : at + NEW_WORDS]).items():
                (long if len(word) > CACHE_CHARS else kept)[word] = entry
        return long

    def _entries(self, words: list[str]) -> dict[str, Entry]:
        """The words as if each followed a space, checked against the library."""
        ids = self._encode_words([MARK + w for w in words])
        if self.check == "words":
            # The library puts a mark before each word itself, but gives none for an empty text.
            self._compare([w.replace(MARK, " ") for w in words], ids, skip_empty=True)
        number = self._numbers.__getitem__
        return {w: tuple(map(number, own)) for w, own in zip(words, ids)}

    def _compare(self, texts: list[str], ids: list[list[int]], skip_empty: bool = False) -> None:
        told = self.library.encode(texts, num_threads=1)
        for text, own, theirs in zip(texts, ids, told):
            if own != theirs and not (skip_empty and text == ""):
                raise ValueError(f"ids differ from the library's for {text[:80]!r}")

    def encode_texts(self, texts: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Of each text the decimal ids, joined by a space, and the ids; without an end id."""
        block, size = [], 0
        for text in texts:
            if block and size + len(text) >= self.cache_words * BLOCK_SHARE:
                yield from self._encode_block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        yield from self._encode_block(block)

    def _encode_block(self, texts: list[str]) -> Iterator[tuple[str, list[int]]]:
        words = [self._words(t) for t in texts]
        with _without_collections():
            long = self._learn(words)
        kept = self._kept
        for text, own in zip(texts, words):
            entries = [kept[w] if w in kept else long[w] for w in own] if long else [kept[w] for w in own]
            ids = list(chain.from_iterable(entries))
            if self.check == "texts":
                self._compare([text], [ids])
            yield " ".join(map(self._decimal.__getitem__, ids)), ids

    def encode(self, text: str, end: bool = True) -> list[int]:
        ((_, ids),) = self.encode_texts([text])
        return ids + [self.library.eos_id()] if end else ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str, check: str, cache_words: int = CACHE_WORDS) -> PieceCodec:
    keep(PURPOSE, codec.cache_clear)
    return PieceCodec(model_file, check, cache_words)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_column(text: Column, model_file: str, check: str = "words") -> Column:
    """The ids of a text column with an end id; null text gives null."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model_file, check)
        for batch in batches:
            yield pd.Series([None if t is None else own.encode(t) for t in batch], dtype=object)

    return ids(text)


def decode_column(ids: Column, model_file: str) -> Column:
    """The text of a column of ids; null ids give null."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model_file, "none")
        for batch in batches:
            yield pd.Series([None if i is None else own.decode(i.tolist()) for i in batch])

    return text(ids)


def digest_column(
    text: Column, model_file: str, check: str = "words", cache_words: int = CACHE_WORDS
) -> Column:
    """Number of ids with the end id, digest of the ids, digest of the decoded text."""

    @F.arrow_udf(RESULT)
    @handing_back(purpose=PURPOSE)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model_file, check, cache_words)
        end = str(own.library.eos_id())
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for text, ids in own.encode_texts(t.as_py() for t in pc.fill_null(batch, "")):
                ids.append(own.library.eos_id())
                counts.append(len(ids))
                of_ids.append(_digest(f"{text} {end}" if text else end))
                of_texts.append(_digest(own.decode(ids)))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digests(text)


def piece_digests(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
    check: str = "words", cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """Encodes every whole text with an end id, decodes it, and digests both.

    One row per row of ``docs``, repeated rows and null ids included; null text
    counts as empty, whose only id is the end.  Other columns are left out.
    ``cache_words`` bounds a worker's memory, not the result: with fewer words
    kept, more of them are encoded again.
    """
    bounded_batches(docs.sparkSession)
    packed = docs.select(
        F.col(id_col).alias("doc_id"),
        digest_column(F.col(text_col), model_file, check, cache_words).alias("codec"),
    )
    return packed.select("doc_id", "codec.n_tokens", "codec.ids_sha256", "codec.decoded_sha256")
