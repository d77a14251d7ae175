"""A quality classifier: a factorisation machine over words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j).  The sum
over pairs takes linear time, as it is half of the square of the sum of v_i x_i
less the sum of the squares.  Words are hashed to a fixed number of features, so
the model has a fixed size however many words there are.

It is fitted on at most ``max_rows`` labelled rows, those whose ids have the
smallest hashes; everything else reads all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import bounded_batches, handing_back
from changeflow.llm.words import blocks

WORD_FEATURES = 1 << 15
MAX_ROWS = 5000
#: Structure statistics, in this order.
STRUCTURE = (
    "upper", "symbols", "bangs", "pipes", "digits", "accents", "distinct", "repeats",
    "word_length", "length", "lines", "no_words",
)

_KIND = np.zeros((256, 6))
_KIND[65:91, 0] = 1
_KIND[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,"], 1] = 1
_KIND[33, 2] = 1
_KIND[124, 3] = 1
_KIND[48:58, 4] = 1
_KIND[128:, 5] = 1
_KIND_OF = _KIND.astype(np.int64)


@dataclass
class Features:
    """Sparse rows: row i has index and value[bounds[i]:bounds[i + 1]]."""

    bounds: np.ndarray
    index: np.ndarray
    value: np.ndarray


def text_features(column: pa.Array, metadata: Sequence[np.ndarray] = ()) -> Iterator[tuple[int, Features]]:
    """Features of texts in blocks, with the number of the first row of each block.

    Words have logarithmic counts scaled to length 1 per text; structure and
    metadata (already between -1 and 1) follow after them.
    """
    wide = len(STRUCTURE) + len(metadata)
    for first, block in blocks(column):
        n = len(block)
        counts = np.diff(block.bounds)
        row = np.repeat(np.arange(n), counts)
        key = row * WORD_FEATURES + (block.hashes % np.uint64(WORD_FEATURES)).astype(np.int64)
        cells, times = np.unique(key, return_counts=True)
        rows, index = cells // WORD_FEATURES, cells % WORD_FEATURES
        value = 1 + np.log(times)
        norm = np.sqrt(np.bincount(rows, value**2, minlength=n))
        value = value / norm[rows]

        # Bytes by kind, from cumulative sums at the texts' bounds.
        starts = np.zeros(n + 1, dtype=np.int64)
        edge = block.offsets
        chars = np.maximum(np.diff(edge), 1)
        kinds = []
        for k in range(_KIND_OF.shape[1]):
            total = np.zeros(len(block.data) + 1, dtype=np.int64)
            np.cumsum(_KIND_OF[block.data, k], out=total[1:])
            kinds.append((total[edge[1:]] - total[edge[:-1]]) / chars)
        words = np.maximum(counts, 1)
        same = np.zeros(len(block.hashes) + 1, dtype=np.int64)
        if len(block.hashes) > 1:
            equal = (block.hashes[1:] == block.hashes[:-1]) & (row[1:] == row[:-1])
            np.cumsum(equal, out=same[2:])
        repeats = (same[block.bounds[1:]] - same[block.bounds[:-1]]) / words
        distinct = np.bincount(rows, minlength=n) / words
        lengths = (block.ends - block.starts).astype(float)
        mean = np.bincount(row, lengths, minlength=n) / words
        newline = np.zeros(len(block.data) + 1, dtype=np.int64)
        np.cumsum(block.data == 10, out=newline[1:])
        lines = (newline[edge[1:]] - newline[edge[:-1]]) / words
        dense = np.stack(
            [
                np.minimum(kinds[0], 1), np.minimum(4 * kinds[1], 1), np.minimum(8 * kinds[2], 1),
                np.minimum(8 * kinds[3], 1), kinds[4], kinds[5], distinct, np.minimum(4 * repeats, 1),
                np.minimum(mean / 20, 1), np.log1p(counts) / 12, np.minimum(4 * lines, 1), counts == 0,
                *[m[first : first + n] for m in metadata],
            ],
            axis=1,
        )
        all_rows = np.concatenate([rows, np.repeat(np.arange(n), wide)])
        all_index = np.concatenate([index, np.tile(WORD_FEATURES + np.arange(wide), n)])
        all_value = np.concatenate([value, dense.ravel()])
        order = np.argsort(all_rows, kind="stable")
        np.cumsum(np.bincount(all_rows, minlength=n), out=starts[1:])
        yield first, Features(starts, all_index[order], all_value[order].astype(np.float32))


class FactorisationMachine:
    """Weights of single features and low-rank weights of their pairs."""

    def __init__(self, features: int, rank: int = 6, seed: int = 7) -> None:
        self.bias = 0.0
        self.single = np.zeros(features, dtype=np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.02, (features, rank)).astype(np.float32)

    def sums(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """The value before the sigmoid of each row, and its sums of factors."""
        value, at = x.value, x.bounds[:-1]
        factors = self.factors[x.index] * value[:, None]
        summed = np.add.reduceat(factors, at, axis=0)
        squares = np.add.reduceat((factors**2).sum(axis=1), at)
        linear = np.add.reduceat(self.single[x.index] * value, at)
        return self.bias + linear + 0.5 * ((summed**2).sum(axis=1) - squares), summed

    def score(self, x: Features) -> np.ndarray:
        if len(x.bounds) < 2:
            return np.zeros(0)
        raw = np.clip(self.sums(x)[0].astype(np.float64), -30, 30)
        return 1 / (1 + np.exp(-raw))

    def fit(
        self, x: Features, y: np.ndarray, epochs: int | None = None, batch: int = 64, rate: float = 0.1,
        decay: float = 1e-4, seed: int = 7,
    ) -> None:
        """Stochastic gradients of the logistic loss with a step per weight (Adagrad).

        Few rows are gone through more often.
        """
        epochs = epochs or min(150, max(12, 60_000 // max(len(y), 1)))
        shuffle = np.random.default_rng(seed)
        single_sq = np.full(self.single.shape, 1e-2, dtype=np.float32)
        factor_sq = np.full(self.factors.shape, 1e-2, dtype=np.float32)
        bias_sq = 1e-2
        share = min(max(float(y.mean()), 0.01), 0.99) if len(y) else 0.5
        self.bias = float(np.log(share / (1 - share)))
        for _ in range(epochs):
            for rows in np.array_split(shuffle.permutation(len(y)), max(1, len(y) // batch)):
                cells = np.concatenate([np.arange(x.bounds[r], x.bounds[r + 1]) for r in rows])
                counts = x.bounds[rows + 1] - x.bounds[rows]
                part = Features(np.concatenate([[0], np.cumsum(counts)]), x.index[cells], x.value[cells])
                raw, summed = self.sums(part)
                slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) / len(rows)
                of_cell = np.repeat(np.arange(len(rows)), counts)
                g = (slope[of_cell] * part.value).astype(np.float32)
                used, place = np.unique(part.index, return_inverse=True)
                g_single = np.bincount(place, g, minlength=len(used)).astype(np.float32)
                g_single += decay * self.single[used]
                mine = self.factors[part.index]
                g_cells = g[:, None] * (summed[of_cell] - mine * part.value[:, None])
                g_factor = np.stack([np.bincount(place, g_cells[:, f], minlength=len(used)) for f in range(mine.shape[1])], axis=1)
                g_factor = g_factor.astype(np.float32) + decay * self.factors[used]
                single_sq[used] += g_single**2
                factor_sq[used] += g_factor**2
                self.single[used] -= rate * g_single / np.sqrt(single_sq[used])
                self.factors[used] -= 0.3 * rate * g_factor / np.sqrt(factor_sq[used])
                g_bias = float(slope.sum())
                bias_sq += g_bias**2
                self.bias -= rate * g_bias / bias_sq**0.5


def _metadata(columns: Sequence[pd.Series]) -> list[np.ndarray]:
    """Numbers on a logarithmic scale; null, negative or no number counts as 0."""
    return [
        np.minimum(np.log1p(np.maximum(pd.to_numeric(c, errors="coerce").fillna(0).to_numpy(float), 0)) / 16, 1)
        for c in columns
    ]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that no label may be learnt from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    metadata: Sequence[str] = (), max_rows: int = MAX_ROWS, folds: int = 5,
) -> FactorisationMachine:
    """Fits the model on at most ``max_rows`` labelled rows that are not held out.

    Labels of one id are averaged; ids or labels that are null don't count.
    Without any label every score is one half.
    """
    clean = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    usable = clean.where(~held_out(F.col("doc_id"), folds)).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    marked = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(metadata)],
    ).join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).drop("doc_id")  # max_rows rows

    @handing_back
    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _metadata([batch.column(f"_m{i}").to_pandas() for i in range(len(metadata))])
            ids, marks = batch.column("_id"), batch.column("label")
            for first, x in text_features(batch.column("_text"), extra):
                n = len(x.bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, n), marks.slice(first, n),
                        pa.ListArray.from_arrays(pa.array(x.bounds, pa.int32()), pa.array(x.index, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(x.bounds, pa.int32()), pa.array(x.value, pa.float32())),
                    ],
                    names=["id", "label", "index", "value"],
                )

    table = marked.mapInArrow(
        featurise, f"id {dict(marked.dtypes)['_id']}, label int, index array<int>, value array<float>"
    ).toArrow()
    model = FactorisationMachine(WORD_FEATURES + len(STRUCTURE) + len(metadata))
    if not table.num_rows:
        model.factors[:] = 0
        return model
    table = table.combine_chunks().sort_by("id").combine_chunks()
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    x = Features(
        index.offsets.to_numpy().astype(np.int64) - index.offsets[0].as_py(),
        index.flatten().to_numpy(), value.flatten().to_numpy(),
    )
    model.fit(x, table.column("label").to_numpy().astype(float))
    return model


def score_column(
    docs: DataFrame, model: FactorisationMachine, text_col: str = "text", metadata: Sequence[str] = ()
) -> Column:
    """The score of each row of ``docs``, 0 to 1; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    bounded_batches(docs.sparkSession)

    @F.arrow_udf("double")
    @handing_back
    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        machine = shared.value
        for texts, *numbers, _ in batches:
            extra = _metadata([n.to_pandas() for n in numbers])
            out = np.zeros(len(texts))
            for first, x in text_features(texts, extra):
                out[first : first + len(x.bounds) - 1] = machine.score(x)
            yield pa.array(out)

    # Of a single column the batches would be bare arrays: a constant makes them tuples.
    return score(F.col(text_col), *[F.col(c).cast("double") for c in metadata], F.lit(0.0))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    metadata: Sequence[str] = (), threshold: float = 0.3, folds: int = 5, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Scores every row: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    One row per row of ``docs``, repeated rows and null ids included.
    """
    model = fit_quality(docs, labels, id_col, text_col, metadata, max_rows, folds)
    scored = docs.select(
        F.col(id_col).alias("doc_id"), score_column(docs, model, text_col, metadata).alias("score")
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    metadata: Sequence[str] = (), threshold: float = 0.3,
) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are."""
    model = fit_quality(docs, labels, id_col, text_col, metadata)
    return docs.where(score_column(docs, model, text_col, metadata) >= threshold)
