"""Scoring texts with a hidden Markov language model.

Latent states emit classes of words, and a class emits its words by their counts:

    P(text) = sum over state paths of  prod P(state | state before) P(class | state)
              times  prod P(word | class)

The most frequent words are classes of their own, the others are classed by
their last two bytes; each class keeps a share for words that were never seen,
so probabilities over all texts sum to one.  The tables of states and classes
have a fixed size.  Counts of words cover all training texts; they are not
bounded, so they stay in Spark and meet the texts in a join, except for words
with more than one in ``FREQUENT`` of all tokens, of which there are fewer than
``FREQUENT``.

Training is Baum-Welch: a start from a bounded sample (``SAMPLE_ROWS``), then
rounds over all training texts, whose expected counts are summed per task and
over tasks.  In training a text is cut into windows; scoring runs the scaled
forward recursion over the whole text, so the likelihood is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import written
from changeflow.llm.words import Words, blocks, mix

STATES = 8
OWN_CLASSES = 3000
ENDING_CLASSES = 1024
FREQUENT = 1 << 19
SAMPLE_ROWS = 1000
WINDOW = 32
ROUNDS = 2
#: Tokens whose classes are gathered before the recursion runs over them side by side.
GATHER = 2_000_000


def endings(block: Words) -> np.ndarray:
    """The class by the last two bytes of each word, from 0."""
    last = block.data[block.ends - 1].astype(np.uint64)
    before = np.where(
        block.ends - block.starts > 1, block.data[np.maximum(block.ends - 2, 0)], 0
    ).astype(np.uint64)
    last = np.where((last >= 65) & (last <= 90), last + np.uint64(32), last)
    before = np.where((before >= 65) & (before <= 90), before + np.uint64(32), before)
    return (mix(before * np.uint64(256) + last) % np.uint64(ENDING_CLASSES)).astype(np.int64)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Texts that nothing may be learnt from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, c) of the texts' words by hash, without the ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def merged() -> pa.RecordBatch:
            word = np.concatenate([p[0] for p in parts])
            word, at, place = np.unique(word, return_index=True, return_inverse=True)
            ending = np.concatenate([p[1] for p in parts])[at]
            c = np.bincount(place, np.concatenate([p[2] for p in parts])).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(c)],
                names=["word", "ending", "c"],
            )

        for batch in batches:
            for _, block in blocks(batch.column(0)):
                word, at, c = np.unique(block.hashes, return_index=True, return_counts=True)
                parts.append((word, endings(block)[at], c))
                held += len(word)
            if held > 1_000_000:
                yield merged()
                parts, held = [], 0
        if parts:
            yield merged()

    found = docs.select("text").mapInArrow(count, "word bigint, ending int, c bigint")
    return found.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What every task knows of the words: bounded tables.

    Classes: 0 is the end, then the endings, then the words of their own.
    """

    words: np.ndarray  # sorted hashes of frequent words
    counts: np.ndarray
    classes: np.ndarray  # class of a frequent word that has its own, else 0
    inside: np.ndarray  # per class: tokens and words and one, 1 for classes of one word
    n_classes: int
    tokens: int
    distinct: int
    end_count: int

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word among the frequent ones, and whether it is one."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def class_of(self, at: np.ndarray, known: np.ndarray, ending: np.ndarray) -> np.ndarray:
        own = np.where(known, self.classes[at] if len(self.classes) else 0, 0)
        return np.where(own > 0, own, 1 + ending)


def lexicon_of(counts: DataFrame, texts: int) -> Lexicon:
    """``counts`` as ``word_counts`` gives them, ``texts`` the number of training texts."""
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = int(whole.n or 0) + texts, int(whole.v or 0) + (texts > 0)
    most = counts.where(F.col("c") * FREQUENT > tokens).select("word", "c").toArrow()
    word = most.column("word").to_numpy().view(np.uint64)
    c = most.column("c").to_numpy()
    order = np.argsort(word)
    word, c = word[order], c[order]
    classes = np.zeros(len(word), dtype=np.int64)
    own = np.lexsort((word, -c))[:OWN_CLASSES]
    classes[own] = 1 + ENDING_CLASSES + np.arange(len(own))
    inside = np.ones(1 + ENDING_CLASSES + len(own))
    sums = counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    for row in sums:
        inside[1 + row.ending] += row.c + row.v
    # Words with a class of their own leave that of their ending.
    if len(own):
        held = counts.where(F.col("c") >= int(c[own].min())).select("word", "ending", "c").toArrow()
        at = np.searchsorted(word, held.column("word").to_numpy().view(np.uint64))
        mine = classes[np.minimum(at, len(word) - 1)] > 0
        np.subtract.at(inside, 1 + held.column("ending").to_numpy()[mine], held.column("c").to_numpy()[mine] + 1)
    return Lexicon(word, c, classes, inside, len(inside), tokens, distinct, texts)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class by state

    @staticmethod
    def random(n_classes: int, share: np.ndarray, seed: int = 11) -> Model:
        draw = np.random.default_rng(seed)
        emit = share[:, None] * draw.gamma(2.0, 1.0, (n_classes, STATES))
        move = draw.gamma(2.0, 1.0, (STATES, STATES)) + 4 * np.eye(STATES)
        return Model(
            np.full(STATES, 1 / STATES), move / move.sum(axis=1, keepdims=True),
            emit / emit.sum(axis=0, keepdims=True),
        )

    @staticmethod
    def of_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """The next model; a little of the overall share keeps every class possible."""
        emit = emit + 5.0 * share[:, None]
        move, start = move + 0.1, start + 0.1
        return Model(
            start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True)
        )


def expected_counts(model: Model, classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Expected counts of starts, moves and emissions of texts cut into windows.

    A window that does not begin a text starts from the model's long-run states.
    """
    first, length, begins = [], [], []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        at = np.arange(lo, hi, WINDOW)
        first.append(at)
        length.append(np.minimum(WINDOW, hi - at))
        begins.append(at == lo)
    first, length, begins = map(np.concatenate, (first, length, begins))
    order = np.argsort(-length, kind="stable")
    first, length, begins = first[order], length[order], begins[order]
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    longrun = np.linalg.matrix_power(model.move, 64)[0].astype(np.float32)
    n, longest = len(first), int(length[0])
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    forward = np.zeros((longest, n, STATES), dtype=np.float32)
    seen = []
    here = np.where(begins[:, None], model.start.astype(np.float32), longrun)
    for t in range(longest):
        m = active[t]
        c = classes[first[:m] + t]
        seen.append(c)
        here = (here[:m] @ move if t else here[:m]) * emit[c]
        here /= here.sum(axis=1, keepdims=True)
        forward[t, :m] = here
    moves = np.zeros((STATES, STATES))
    counts = np.zeros((len(emit), STATES))
    back = np.ones((n, STATES), dtype=np.float32)
    start = np.zeros(STATES)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        posterior = forward[t, :m] * back[:m]
        posterior /= posterior.sum(axis=1, keepdims=True)
        for s in range(STATES):
            counts[:, s] += np.bincount(seen[t], posterior[:, s], minlength=len(emit))
        if t == 0:
            start = posterior[begins].sum(axis=0, dtype=np.float64)
        else:
            onward = emit[seen[t]] * back[:m]
            before = forward[t - 1, :m]
            scale = ((before @ move) * onward).sum(axis=1, keepdims=True)
            moves += (before / scale).T.astype(np.float64) @ onward.astype(np.float64) * model.move
            back[:m] = (onward / scale) @ move.T
    return start, moves, counts


def likelihoods(model: Model, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The natural logarithm of the probability of each text's classes, over all paths."""
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    first, length = bounds[:-1][order], length[order]
    total = np.zeros(len(first))
    if not len(first) or not length[0]:
        return total
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    here = np.broadcast_to(model.start, (len(first), STATES))
    for t in range(length[0]):
        m = active[t]
        here = (here[:m] @ model.move if t else here[:m]) * model.emit[classes[first[:m] + t]]
        scale = here.sum(axis=1)
        here = here / scale[:, None]
        total[:m] += np.log(scale)
    out = np.zeros(len(first))
    out[order] = total
    return out


def _classes(lexicon: Lexicon, column: pa.Array) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, block, places, known, endings, classes) of a text column's blocks."""
    for first, block in blocks(column):
        ending = endings(block)
        at, known = lexicon.look_up(block.hashes)
        yield first, block, at, known, ending, lexicon.class_of(at, known, ending)


def _with_ends(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's classes with the end, class 0, after them."""
    return np.insert(classes, bounds[1:], 0), bounds + np.arange(len(bounds))


def _summed(docs: DataFrame, lexicon: Lexicon, model: Model) -> tuple[np.ndarray, ...]:
    """Expected counts over all texts of ``docs``: one array per task, summed in Spark."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, model))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, now = shared.value
        total = np.zeros((words.n_classes + 1 + STATES, STATES))
        for batch in batches:
            for _, block, _, _, _, classes in _classes(words, batch.column(0)):
                start, moves, emitted = expected_counts(now, *_with_ends(classes, block.bounds))
                total[0] += start
                total[1 : 1 + STATES] += moves
                total[1 + STATES :] += emitted
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used)] + [pa.array(total[used, s]) for s in range(STATES)],
                names=["cell", *(f"s{s}" for s in range(STATES))],
            )

    columns = [f"s{s}" for s in range(STATES)]
    found = docs.select("text").mapInArrow(count, "cell bigint, " + ", ".join(f"{c} double" for c in columns))
    table = found.groupBy("cell").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    total = np.zeros((lexicon.n_classes + 1 + STATES, STATES))
    total[table.column("cell").to_numpy()] = np.stack([table.column(c).to_numpy() for c in columns], axis=1)
    return total[0], total[1 : 1 + STATES], total[1 + STATES :]


def fit(docs: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Baum-Welch: many rounds on a bounded sample, then ``rounds`` over all texts."""
    sample = docs.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("id").distinct()
    rows = docs.join(F.broadcast(sample), "id").select("text").limit(2 * sample_rows).toArrow()  # at most sample_rows ids
    share = np.full(lexicon.n_classes, 1.0)
    parts = []
    for _, block, _, _, _, classes in _classes(lexicon, rows.column("text")):
        parts.append(_with_ends(classes, block.bounds))
    for classes, _ in parts:
        share += np.bincount(classes, minlength=lexicon.n_classes)
    share /= share.sum()
    model = Model.random(lexicon.n_classes, share)
    for _ in range(12 if parts else 0):
        sums = [expected_counts(model, *p) for p in parts if len(p[0])]
        model = Model.of_counts(*[sum(x) for x in zip(*sums)], share)
    for _ in range(rounds):
        start, moves, emitted = _summed(docs, lexicon, model)
        share = (emitted.sum(axis=1) + 1) / (emitted.sum() + lexicon.n_classes)
        model = Model.of_counts(start, moves, emitted, share)
    return model


def _parts(docs: DataFrame, lexicon: Lexicon, model: Model) -> DataFrame:
    """Per text a row with what its frequent words give, and a row for each other word.

    Kind 0: tokens, known tokens, sums of logarithms for base and model.
    Kind 1: a word's hash and how often the text has it.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hmm = shared.value
        log_inside = np.log10(words.inside)
        log_count = np.log10(words.counts + 1.0)
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            classes = np.concatenate([h[4] for h in held])
            lengths = np.concatenate([np.diff(h[5]) for h in held])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            logs = likelihoods(hmm, classes, bounds) / np.log(10)
            ids = pa.concat_arrays([h[0] for h in held])
            digests = pa.array(np.concatenate([h[1] for h in held]).view(np.int64))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(n, np.int8)), ids, digests, pa.nulls(n, pa.int64()),
                    pa.array(lengths), pa.array(np.concatenate([h[2] for h in held])),
                    pa.array(np.concatenate([h[3] for h in held])),
                    pa.array(np.concatenate([h[6] for h in held]) + logs),
                ],
                names=PARTS,
            )

        for batch in batches:
            for first, block, at, known, ending, classes in _classes(words, batch.column(1)):
                n = len(block)
                row = np.repeat(np.arange(n), np.diff(block.bounds))
                ids = batch.column(0).slice(first, n)
                digest = mix(np.bincount(row, minlength=n).astype(np.uint64))
                place = np.arange(len(row), dtype=np.uint64) - block.bounds[row].astype(np.uint64)
                np.add.at(digest, row, mix(block.hashes + mix(place)))
                own = classes > ENDING_CLASSES
                base = np.bincount(row[known], log_count[at[known]], minlength=n).astype(float)
                both = known & ~own
                inner = np.bincount(row[both], log_count[at[both]], minlength=n).astype(float)
                inner -= np.bincount(row[~own], log_inside[classes[~own]], minlength=n)
                known_tokens = np.bincount(row[known], minlength=n) + (words.end_count > 0)
                ended = _with_ends(classes, block.bounds)
                held.append((
                    ids, digest, known_tokens.astype(np.int64), base + np.log10(words.end_count + 1.0),
                    ended[0], ended[1], inner,
                ))
                size += len(ended[0])
                rare = np.flatnonzero(~known)
                if len(rare):
                    order = rare[np.lexsort((block.hashes[rare], row[rare]))]
                    r, h = row[order], block.hashes[order]
                    new = np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
                    spot = np.flatnonzero(new)
                    times = np.diff(np.append(spot, len(order)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.ones(len(spot), np.int8)), ids.take(pa.array(r[spot])),
                            pa.array(digest[r[spot]].view(np.int64)), pa.array(h[spot].view(np.int64)),
                            pa.array(times), pa.nulls(len(spot), pa.int64()),
                            pa.nulls(len(spot), pa.float64()), pa.nulls(len(spot), pa.float64()),
                        ],
                        names=PARTS,
                    )
                if size > GATHER:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select("id", "text").mapInArrow(
        score,
        "kind tinyint, id bigint, digest bigint, word bigint, n bigint, known bigint, base double, inner double",
    )


PARTS = ["kind", "id", "digest", "word", "n", "known", "base", "inner"]


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The model's log10 probability of every whole text, and a unigram's.

    Learns from rows whose id's crc32 modulo ``folds`` is not ``fold``; a null id
    is held out.  One row per row of ``docs``: doc_id, held_out, n_tokens (words
    and one end), n_known, train_tokens, base_score, score.  Null text counts as
    empty.  Without training rows every word is unknown.
    """
    named = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    train = named.where(~held_out(F.col("id"), folds, fold))
    counts = written(word_counts(train), "word-counts")
    lexicon = lexicon_of(counts, train.count())
    model = fit(train, lexicon, rounds) if lexicon.end_count else Model.random(
        lexicon.n_classes, np.full(lexicon.n_classes, 1 / lexicon.n_classes)
    )
    parts = written(_parts(named, lexicon, model), "score-parts")
    rare = parts.where("kind = 1").select("id", "digest", "word", "n")
    seen = counts.where(F.col("c") * FREQUENT <= lexicon.tokens).select("word", "c")
    found = rare.join(seen, "word").groupBy("id", "digest").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more")
    )
    # Rows of one id and text share their words' rows; each such row counted them all.
    texts = parts.where("kind = 0").groupBy("id", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("known").alias("known"),
        F.first("base").alias("base"), F.first("inner").alias("inner"),
    )
    same = texts.join(
        found.withColumnsRenamed({"id": "f_id", "digest": "f_digest"}),
        F.col("id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest")), "left",
    )
    more = F.coalesce(F.col("more") / F.col("copies"), F.lit(0.0))
    each = same.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        F.col("id").alias("doc_id"), held_out(F.col("id"), folds, fold).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce((F.col("more_known") / F.col("copies")).cast("bigint"), F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n") * float(np.log10(lexicon.tokens + lexicon.distinct + 1))).alias("base_score"),
        (F.col("inner") + more).alias("score"),
    )
