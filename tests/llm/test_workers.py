"""What a Python worker keeps from task to task goes when it gets tasks of another purpose."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from changeflow.llm import jaccard_join, piece_codec, tables, words
from changeflow.llm.tables import handing_back


def echo(batches):
    yield from batches


def test_a_codec_stays_for_its_own_tasks_only():
    model = public_tokenizers.path("piece_bpe_32k.model")
    own = piece_codec.codec(model, "none")
    assert list(handing_back(echo, purpose=piece_codec.PURPOSE)([1, 2])) == [1, 2]
    assert piece_codec.codec(model, "none") is own
    assert list(handing_back(echo)([1, 2])) == [1, 2]
    assert piece_codec.codec.cache_info().currsize == 0
    assert piece_codec.codec(model, "none") is not own


def test_workers_drop_the_codec(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string").coalesce(1)
    first = sorted(piece_codec.piece_digests(docs, model).collect())

    @handing_back
    def kept(batches):
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(tables._KEPT), piece_codec.codec.cache_info().currsize]})

    found = spark.range(8, numPartitions=8).mapInArrow(kept, "n long").collect()
    assert found and all(r.n == 0 for r in found)
    assert sorted(piece_codec.piece_digests(docs, model).collect()) == first


def test_a_small_cache_gives_the_same_ids_and_keeps_few_words():
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = [" ".join(f"w{i * j % 997}x{j}" for j in range(60)) for i in range(40)] + ["", " ", "y" * 90, "a  b " * 300]
    large, small = piece_codec.PieceCodec(model), piece_codec.PieceCodec(model, cache_words=100)
    assert list(small.encode_texts(iter(texts))) == list(large.encode_texts(texts))
    assert [ids for _, ids in small.encode_texts(texts)] == small.library.encode(texts)
    # No more than those of one block, or the cache's bound.
    assert len(small._kept) <= 1_000 < len(large._kept)


def test_kept_words_share_their_ids():
    own = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    list(own.encode_texts(["resharing sharing unsharing"]))
    numbers = {id(n) for n in own._numbers}
    assert own._kept and all(id(n) in numbers for entry in own._kept.values() for n in entry)


def peak_mb(work):
    """What numpy and Python took at most, beyond what they had."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def test_hashing_words_takes_little_memory():
    column = pa.array([" ".join(f"w{i * j % 9973}" for j in range(300)) for i in range(3000)])
    assert column.nbytes > 4 << 20
    tables_mb = sum(t.nbytes for t in words._POWERS) / (1 << 20)
    assert tables_mb < 5
    assert peak_mb(lambda: [None for _ in words.distinct_shingles(column, 5)]) < 16


def test_blocks_of_any_size_give_the_same_shingles(monkeypatch):
    texts = [" ".join(f"w{i * j % 97}" for j in range(i % 50)) for i in range(400)] + ["é" * 3000 + " x y", "", None]
    column = pa.array(texts)
    expected = [own.tolist() for own in words.distinct_shingles(column, 4)]
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(words, "BLOCK_BYTES", size)
        monkeypatch.setattr(words, "_POWERS", tuple(words._powers(b, size) for b in (words._BASE, words._INVERSE)))
        assert [own.tolist() for own in words.distinct_shingles(column, 4)] == expected


def members(n, shingles):
    """Sets in one group, each with a component of its own, that share a key."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 62, shingles, dtype=np.uint64)
    own = [np.sort(np.concatenate([common, rng.integers(0, 1 << 62, 9, dtype=np.uint64)])) for _ in range(n)]
    return pa.table({
        "group": pa.array([1] * n, pa.int64()), "side": pa.array([2] * n, pa.int32()), "id": pa.array(range(n), pa.int64()),
        "comp": pa.array(range(n), pa.int64()), "n": pa.array([len(s) for s in own], pa.int64()),
        "whole": pa.array([jaccard_join.whole_sketch(s).tobytes() for s in own], pa.binary()),
        "keys": pa.array([[7]] * n, pa.list_(pa.int64())),
    })


def test_comparing_sketches_takes_little_memory():
    table = members(700, 120)  # 244,650 pairs of 8 words

    def work():
        assert sum(len(left) for left, _, _ in jaccard_join._near_pairs(table, 80)) == 700 * 699 // 2

    assert peak_mb(work) < 40


def test_portions_of_any_size_give_the_same_pairs(monkeypatch):
    table = members(60, 40)

    def pairs():
        return sorted(x for part in jaccard_join._near_pairs(table, 70) for x in zip(*(p.tolist() for p in part)))

    expected = pairs()
    assert expected
    for size in (1, 300, 1 << 21):
        monkeypatch.setattr(jaccard_join, "PAIR_WORDS", size)
        assert pairs() == expected
