"""Removes long passages that repeat across documents, by de Bruijn compaction.

In the token graph an edge is a run of ``window`` words and joins the runs of
``window - 1`` words that it begins and ends with; a document is a path.  A passage
that documents share is a path that they have in common.

1. Compaction starts in the documents.  The anchor of an edge is its least hashed
   run of ``ANCHOR`` words, the leftmost of equals; so equal edges have equal
   anchors.  Adjacent edges with one anchor are a piece of a path and make one row:
   anchor, digests of all its words, source coordinates.  Equal anchors meet in
   one place, so do all occurrences of an edge.
2. An anchor in one document only has edges that nothing repeats: it goes.  An
   anchor with one piece, however many documents have it, does not branch: all of
   its edges lie on one path, and the least document of the piece has them first.
3. Where an anchor has several pieces the path branches within them.  Documents
   that have a piece whole, and not first, are done.  The first document of each
   piece looks up its edges one by one at their source coordinates, and the edges
   of such pieces are joined with one another.

What is shuffled is a row per piece, about one for every (window - ANCHOR) / 2
words, then only what repeats; edges one by one only where paths branch, and whole
texts only by document.  Edges and pieces are equal if two 64-bit digests are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import bounded_batches, text_or_empty, written
from changeflow.llm.words import BLOCK_BYTES, Words, mix

WINDOW, ANCHOR = 50, 20
#: Rows that a task gathers before it hands them on.
ROWS = 50_000

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_BASES = (0xD6E8FEB86659FD93, 0x9FB21C651E98DF25)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = [_powers(b, BLOCK_BYTES) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64), BLOCK_BYTES) for b in _BASES]


def _both(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= BLOCK_BYTES:
        return _UP[which], _DOWN[which]
    return _powers(_BASES[which], n), _powers(pow(_BASES[which], -1, 1 << 64), n)


class Spans(Words):
    """The words of some texts, unchanged, and digests of any runs of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        super().__init__(data, offsets)
        n = len(self.hashes)
        self._sums, self._inverse = [], []
        for which, hashes in enumerate((self.hashes, mix(self.hashes ^ np.uint64(0x2545F4914F6CDD1D)))):
            up, down = _both(which, n)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(hashes * up[:n], out=sums[1:])
            self._sums.append(sums)
            self._inverse.append(down)

    def _hash(self) -> np.ndarray:
        n = len(self.data)
        up, down = _both(0, n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def digest(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """Of the words from ``starts`` to before ``ends``."""
        sums = self._sums[which]
        h = (sums[ends] - sums[starts]) * self._inverse[which][starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def edges(self, window: int) -> np.ndarray:
        """Where runs of ``window`` words of one text begin."""
        n, counts = len(self.hashes), np.diff(self.bounds)
        last = np.repeat(self.bounds[1:], counts)
        return np.flatnonzero(np.arange(n) + window <= last)

    def anchors(self, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words, and the anchor's place of every edge."""
        n = len(self.hashes)
        at = np.arange(n - size + 1)
        h = self.digest(at, at + size)
        # The least of 2, 4, 8 ... runs, then of window - size + 1 by two that overlap.
        runs, width = window - size + 1, 1
        while width * 2 <= runs:
            at = self._least(h, at[:-width], at[width:])
            width *= 2
        rest = runs - width
        return h, self._least(h, at[:-rest], at[rest:]) if rest else at

    @staticmethod
    def _least(h: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(h[right] < h[left], right, left)


def span_blocks(column: pa.Array) -> Iterator[tuple[int, Spans]]:
    """The words of a text column without nulls, in blocks of rows, with the first row's number."""
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), n)
        part = offsets[at : to + 1]
        yield at, Spans(data[part[0] : part[-1]], part - part[0])
        at = to


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, body, text): rows of one id and text are the same document."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))


def _pieces(docs: DataFrame, window: int, size: int) -> DataFrame:
    """A row per piece: anchor, two digests of its words, doc_id, body, first word, edges."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["anchor", "one", "two", "doc_id", "body", "at", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for first, block in span_blocks(batch.column(2)):
                edges = block.edges(window)
                if not len(edges):
                    continue
                h, places = block.anchors(window, size)
                places = places[edges]
                begins = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
                n = np.diff(np.append(begins, len(edges)))
                starts = edges[begins]
                ends = starts + n - 1 + window
                text = np.searchsorted(block.bounds, starts, side="right") - 1
                row = pa.array(text + first)
                held.append(pa.RecordBatch.from_arrays(
                    [
                        _signed(h[places[begins]]), _signed(block.digest(starts, ends)),
                        _signed(block.digest(starts, ends, 1)), batch.column(0).take(row), batch.column(1).take(row),
                        pa.array(starts - block.bounds[text]), pa.array(n),
                    ],
                    names=names,
                ))
                rows += len(starts)
                if rows > ROWS:
                    yield from held
                    held, rows = [], 0
        yield from held

    return docs.mapInArrow(
        cut, f"anchor bigint, one bigint, two bigint, doc_id {id_type}, body bigint, at bigint, n bigint"
    )


def _branches(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The edges of pieces, looked up in their documents: one, two, doc_id, body, at."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = wanted.groupBy("doc_id", "body").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    found = docs.join(lists, ["doc_id", "body"]).select("doc_id", "body", "text", "spans")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(3)
            for first, block in span_blocks(batch.column(2)):
                own = spans.slice(first, len(block))
                counts = own.value_lengths().to_numpy(zero_copy_only=False)
                flat = own.flatten()
                at, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                text = np.repeat(np.arange(len(block)), counts)
                # Every edge of every span.
                text, offset = np.repeat(text, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(at, n) + offset
                starts = block.bounds[text] + at
                row = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(block.digest(starts, starts + window)),
                        _signed(block.digest(starts, starts + window, 1)),
                        batch.column(0).take(row), batch.column(1).take(row), pa.array(at),
                    ],
                    names=["one", "two", "doc_id", "body", "at"],
                )

    return found.mapInArrow(look_up, f"one bigint, two bigint, doc_id {id_type}, body bigint, at bigint")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Runs of edges that also begin in a document with a smaller id.

    Columns: doc_id, body (xxhash64 of the text), at (the first word's number), n
    (edges, so it covers n + window - 1 words), source (the smallest such id).  Runs
    of one document do not overlap in edges but may touch.  Rows without an id repeat
    nothing and are repeated by nothing, as their ids are not comparable; rows of
    one id never repeat each other.
    """
    if not 0 < anchor <= window:
        raise ValueError(f"anchors of {anchor} words in windows of {window}")
    bounded_batches(docs.sparkSession)
    known = _identified(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    pieces = written(_pieces(known, window, anchor), "pieces")
    # Written, so that the join's rows come in an exchange of their own, whose hot
    # keys Spark can split; the same below.
    ends = written(pieces.groupBy("anchor").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"),
        ((F.min("one") != F.max("one")) | (F.min("two") != F.max("two"))).alias("branching"),
    ).where("last != source").drop("last"), "anchors")
    shared = written(pieces.join(ends, "anchor"), "shared")
    result = ["doc_id", "body", "at", "n", "source"]
    straight = shared.where("not branching and doc_id > source").select(result)

    piece = ["anchor", "one", "two"]
    forks = shared.where("branching").drop("source", "branching")
    firsts = written(forks.groupBy(*piece).agg(F.min("doc_id").alias("source")), "firsts")
    judged = written(forks.join(firsts, piece), "forks")
    whole = judged.where("doc_id > source").select(result)
    edges = written(_branches(known, judged.where("doc_id = source"), window), "edges")
    edge_firsts = written(edges.groupBy("one", "two").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last")
    ).where("last > source").drop("last"), "edge-firsts")
    single = edges.join(edge_firsts, ["one", "two"]).where("doc_id > source").select(
        "doc_id", "body", "at", F.lit(1).cast("bigint").alias("n"), "source"
    )
    return straight.unionByName(whole).unionByName(single)


RESULT = "n_words bigint, n_removed bigint, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
    keep_text: bool = False,
) -> DataFrame:
    """Every document without the words that such runs cover.

    One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the
    kept words joined by one space), and with ``keep_text`` also kept_text.  Null
    text has no words; a text of fewer words than a window keeps all, as do rows
    without an id.  An empty table gives no rows; other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, window, anchor)
    lists = spans.groupBy("doc_id", "body").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    lists = written(lists, "removed")
    joined = _identified(docs, id_col, text_col).join(lists, ["doc_id", "body"], "left").select(
        "doc_id", "text", "spans"
    )
    id_type = joined.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, removed, digests, texts = [], [], [], []
            spans = batch.column(2)
            starts = spans.offsets.to_numpy()
            at, n = (spans.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            some = spans.is_valid().to_numpy(zero_copy_only=False)
            for i, text in enumerate(batch.column(1)):
                own = text.as_buffer().to_pybytes().split()
                words.append(len(own))
                if some[i]:
                    here = slice(starts[i], starts[i + 1])
                    cover = np.zeros(len(own) + 1, dtype=np.int64)
                    np.add.at(cover, at[here], 1)
                    np.add.at(cover, at[here] + n[here] + window - 1, -1)
                    stays = (np.cumsum(cover) == 0).tolist()
                    own = [w for w, s in zip(own, stays) if s]
                removed.append(words[-1] - len(own))
                kept = b" ".join(own)
                digests.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    texts.append(kept.decode("utf-8", "replace"))
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(remove, f"doc_id {id_type}, {RESULT}" + (", kept_text string" if keep_text else ""))
