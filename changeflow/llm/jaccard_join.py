"""Joining documents by the Jaccard similarity of their word shingles, exactly.

A parity sketch has a bit per hash value, flipped by each shingle; the bits that
differ between two sketches are at most the shingles that are in one set only.
Sets with similarity t differ in at most d = (1 - t) / (1 + t) * (|A| + |B|)
shingles, so of d + 1 + s blocks of shingles, each xored to 64 bits, at least s + 1
are the same.

1. Sizes are put in bands.  A set is sketched for its own band and for those
   that a smaller partner may be in, each with the band's number of blocks.  The
   blocks are keys.  A set may do without s of its keys, as one of the s + 1 that
   a link shares is left: first those without a bit set, then those that most
   sets have.  All sets rank keys alike, so the rarest of the shared keys stays
   on both sides, and passages that many documents share bring no pairs.
2. Sets that share a key form a star around the smallest id.  Of the stars of a
   set the one with most shared keys is verified on the whole texts, and what
   is linked is put in components.  Thousands of near copies cost one pair each.
3. Only keys whose members are still in different components are left.  Their
   members are compared by whole sketches, in parts of bounded size.  First each
   set is verified against its nearest one in another component.  Where components
   still differ, the sets with a sketch that allows a link meet again with their texts;
   there all such pairs are verified, the nearest first, until they are joined.  No
   pair leaves its task unless it joins two components.

No link between different components is lost, so the components are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.components import connected_components
from changeflow.llm.tables import bounded_batches, handing_back, written
from changeflow.llm.words import distinct_shingles, mix

#: The largest size of a band over its smallest.
BAND = 1.5
#: Members of a key that are compared in one task at once.
PART = 4096
#: Shingles of those members, 8 bytes each.
PART_SHINGLES = 1 << 22
#: Keys of members, and bytes of their rows, that a task gathers before it compares whole groups of them.
HELD_KEYS, HELD_BYTES = 200_000, 32 << 20
#: Members beyond which keys count as equally frequent.
MANY = 200_000
#: 64-bit words of sketches that are compared at once; a portion takes some 30 bytes for each.
PAIR_WORDS = 1 << 19
#: Marks the bands of sets with too many empty blocks; bands are below it, as sets are below BAND ** 64.
SPARSE = 1 << 6
#: The high bits of a key have its band and the mark, the low ones its hash.
HASH_BITS = 57
#: Keys that a task gathers before it packs them by the task they go to.
PACKED = 1 << 19


class Bands:
    """Size bands and their numbers of blocks for a similarity of percent / 100."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError(f"percent must be 1 to 100: {percent}")
        self.percent = percent

    def band_of(self, n: int) -> int:
        return int(math.floor(math.log(n) / math.log(BAND) + 1e-9))

    def largest(self, band: int) -> int:
        return int(math.ceil(BAND ** (band + 1) + 1e-6))

    def differences(self, band: int) -> int:
        """The most shingles that may differ where the smaller set is in the band."""
        small, t = self.largest(band), self.percent
        big = small * 100 // t
        return (100 - t) * (small + big) // (100 + t)

    def blocks(self, band: int) -> tuple[int, int]:
        """Blocks of a sketch, and how many of the blocks that agree are to spare."""
        d = self.differences(band)
        spare = max(1, (d + 2) // 4) if d else 0
        return d + 1 + spare, spare

    def bands_of(self, n: int) -> list[int]:
        """The set's own band and those of smaller partners."""
        least = -(-n * self.percent // 100)
        return list(range(self.band_of(max(least, 1)), self.band_of(n) + 1))

    def can_link(self, a: int, b: int) -> bool:
        return 100 * min(a, b) >= self.percent * max(a, b)


def block_sketch(shingles: np.ndarray, band: int, blocks: int) -> np.ndarray:
    """The xor of the hashes of each block's shingles; 0 for an empty block.

    A shingle that only one of two sets has changes one block.  64 parity bits, one
    flipped by each shingle, would do as well but for chance: the blocks of two
    or three shingles of unlike sets have few such patterns and often agree.
    """
    h = mix(shingles + np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    order = np.argsort(block)
    block, h = block[order], mix(h[order] ^ np.uint64(0xC2B2AE3D27D4EB4F))
    starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    out = np.zeros(blocks, dtype=np.uint64)
    out[block[starts].astype(np.int64)] = np.bitwise_xor.reduceat(h, starts)
    return out


def block_keys(shingles: np.ndarray, band: int, bands: Bands) -> list[tuple[int, int, np.ndarray]]:
    """(code, room, keys) of a set in a band; room is the number of keys it may do without.

    The code is the band, with ``SPARSE`` for the second kind of keys; it is in the
    high bits of the keys.  Blocks without a bit are the first that a set does
    without.  A set with more of them than are to spare needs all its other keys, as
    a partner may count on any of them; two such sets may agree in empty blocks only,
    so they also have keys of all blocks, apart from the other keys, and do without
    the spare ones.
    """
    blocks, spare = bands.blocks(band)
    bits = block_sketch(shingles, band, blocks)
    number = np.arange(blocks, dtype=np.uint64) + np.uint64(band << 40)
    keys = mix(bits ^ mix(number + np.uint64(77)))
    filled = keys[bits != 0]
    room = spare - (blocks - len(filled))
    if room >= 0:
        return [(band, room, _coded(band, filled))]
    sparse = band | SPARSE
    return [(band, 0, _coded(band, filled)), (sparse, spare, _coded(sparse, mix(keys ^ np.uint64(SPARSE))))]


def _coded(code: int, keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - HASH_BITS) | np.uint64(code << HASH_BITS)


def whole_sketch(shingles: np.ndarray) -> np.ndarray:
    """A parity sketch of at least two bits per shingle, a power of two of 64-bit words.

    The first half of a sketch xor its second half is the sketch of half the size.
    """
    words = 1
    while words * 32 < len(shingles):
        words *= 2
    place = (mix(shingles) >> np.uint64(8)).astype(np.int64) & (words * 64 - 1)
    odd = (np.bincount(place, minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


SKETCHES = (
    "kind tinyint, id bigint, n bigint, sum bigint, other bigint, whole binary, code int, part int, packed binary"
)
SETS, ROOMS, KEYS = 0, 1, 2


def _sketches(docs: DataFrame, k: int, bands: Bands, parts: int) -> DataFrame:
    """The sketches of all documents, in one pass, as three kinds of rows.

    ``SETS``: one per document with its size n, a digest of its set and its whole
    sketch.  ``ROOMS``: for an id and the code of its keys, n is the number of keys that
    it may do without.  ``KEYS``: the keys of many sets that go to one of ``parts`` tasks, packed.
    A set that a task has seen already has no keys again; its digest tells that it is equal.
    """

    @handing_back
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        key_ids, keys, held = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            own_ids, sizes, sums, others, wholes = [], [], [], [], []
            room_ids, codes, rooms = [], [], []
            for i, own in zip(ids, distinct_shingles(batch.column(1), k)):
                n = len(own)
                first = int(mix(own + np.uint64(1)).sum(dtype=np.uint64)) if n else 0
                second = int(np.bitwise_xor.reduce(mix(own ^ np.uint64(0x5851F42D4C957F2D)))) if n else 0
                own_ids.append(i)
                sizes.append(n)
                sums.append(first)
                others.append(second)
                wholes.append(whole_sketch(own).tobytes() if n else b"")
                if not n or i is None or (n, first, second) in seen:
                    continue
                seen.add((n, first, second))
                for band in bands.bands_of(n):
                    for code, room, found in block_keys(own, band, bands):
                        room_ids.append(i)
                        codes.append(code)
                        rooms.append(room)
                        keys.append(found)
                        key_ids.append(np.full(len(found), i, dtype=np.int64))
                        held += len(found)
                if held > PACKED:
                    yield _packed(key_ids, keys, parts)
                    key_ids, keys, held = [], [], 0
            yield _rows(len(own_ids), SETS, id=own_ids, n=sizes, sum=_signed(sums), other=_signed(others), whole=wholes)
            yield _rows(len(room_ids), ROOMS, id=room_ids, n=rooms, code=codes)
        if keys:
            yield _packed(key_ids, keys, parts)

    return docs.mapInArrow(sketch, SKETCHES)


def _rows(length: int, kind: int, **given: list | np.ndarray) -> pa.RecordBatch:
    """Rows of a kind; columns that it does without are null."""
    types = {
        "id": pa.int64(), "n": pa.int64(), "sum": pa.int64(), "other": pa.int64(), "whole": pa.binary(),
        "code": pa.int32(), "part": pa.int32(), "packed": pa.binary(),
    }
    columns = [pa.array(given[c], t) if c in given else pa.nulls(length, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(length, kind, np.int8)), *columns], names=["kind", *types])


def _signed(numbers: list[int]) -> np.ndarray:
    return np.array(numbers, dtype=np.uint64).view(np.int64)


def _packed(ids: list[np.ndarray], keys: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """One row for each part that has keys: n keys, then their ids as differences.

    A row of its own would cost a key its id and header in the shuffle, the more the
    more tasks there are; here ids come in the order of the documents and compress.
    """
    key, id_ = np.concatenate(keys), np.concatenate(ids)
    part = ((mix(key) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    key, id_, part = key[order], id_[order], part[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    bounds = np.append(starts, len(key))
    cut = [
        key[a:b].tobytes() + np.diff(id_[a:b], prepend=np.int64(0)).tobytes()
        for a, b in zip(bounds[:-1], bounds[1:])
    ]
    return _rows(len(cut), KEYS, n=np.diff(bounds), part=part[starts].astype(np.int32), packed=cut)


def _unpacked(packed: DataFrame, parts: int) -> DataFrame:
    """The rows (key, id) of packed keys, each part in a task."""

    @handing_back
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                numbers = np.frombuffer(row.as_buffer(), dtype=np.int64)
                key, steps = numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.cumsum(steps))], names=["key", "id"])

    dealt = packed.repartitionById(parts, F.col("part")).select("packed")
    return dealt.mapInArrow(unpack, "key bigint, id bigint")


def _shared(packed: DataFrame, parts: int) -> DataFrame:
    """The rows (key, id, hub, members, alike) of keys with two ids at least.

    The hub is the smallest id; alike is a digest of all members.  Rows come in order
    of key and id; of a key with more than ``MANY`` rows the first are sent on before
    the last have come, and its members count as ``MANY``, as for every such key; such
    a key is alike to itself only.
    """

    @handing_back
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * 2
        long_key, long_hub = None, 0

        def sent(key: np.ndarray, id_: np.ndarray) -> pa.RecordBatch:
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (id_[1:] != id_[:-1])])
            key, id_ = key[new], id_[new]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            hub, members = np.repeat(id_[starts], sizes), np.minimum(np.repeat(sizes, sizes), MANY)
            digests = np.add.reduceat(mix(id_.view(np.uint64) ^ np.uint64(0x9E6C63D0876A9A35)), starts)
            alike = np.repeat(digests.view(np.int64), sizes)
            if long_key is not None and key[0] == long_key:
                hub[: sizes[0]], members[: sizes[0]], alike[: sizes[0]] = long_hub, MANY, long_key
            several = members > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(x[several]) for x in (key, id_, hub, members, alike)],
                names=["key", "id", "hub", "members", "alike"],
            )

        for batch in batches:
            waiting = [np.concatenate([w, batch.column(i).to_numpy()]) for i, w in enumerate(waiting)]
            key = waiting[0]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if len(key) - last > MANY:
                if last:
                    yield sent(*[w[:last] for w in waiting])
                if key[-1] != long_key:
                    long_key, long_hub = key[-1], waiting[1][last]
                yield sent(*[w[last:] for w in waiting])
                waiting = [w[:0] for w in waiting]
            elif last:
                yield sent(*[w[:last] for w in waiting])
                waiting = [w[last:] for w in waiting]
        if len(waiting[0]):
            yield sent(*waiting)

    ordered = _unpacked(packed, parts).sortWithinPartitions("key", "id")
    return ordered.mapInArrow(stars, "key bigint, id bigint, hub bigint, members bigint, alike bigint")


def _needed(shared: DataFrame, rooms: DataFrame) -> DataFrame:
    """The keys that a set can't do without: all but the most frequent ones it has room to leave.

    Of a set's keys with the same members only the last is a row, with the number of
    keys it stands for.  All its members have all these keys, in the same order, and
    whoever keeps one of them keeps the last, so that it brings the pairs of all.
    """
    room = rooms.groupBy("id", "code").agg(F.max("n").alias("room"))  # repeated rows have the same
    coded = shared.withColumn("code", F.shiftrightunsigned("key", HASH_BITS).cast("int"))
    order = Window.partitionBy("id", "code").orderBy(F.col("members").desc(), "key")
    ranked = coded.join(room, ["id", "code"]).withColumn("rank", F.row_number().over(order))
    kept = ranked.where("rank > room").groupBy("id", "code", "members", "alike", "hub")
    return kept.agg(F.max("key").alias("key"), F.count(F.lit(1)).alias("keys")).select("key", "id", "hub", "keys")


def _near_pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (left, right) of sets of different components whose sketches allow a link, and how far they are apart.

    The sets of a pair share a key in a group.  Pairs come in portions of bounded size.
    """
    keys = table.column("keys").combine_chunks()
    row = np.repeat(np.arange(len(table)), keys.value_lengths().to_numpy())
    key, group, n = keys.flatten().to_numpy(), table.column("group").to_numpy()[row], table.column("n").to_numpy()[row]
    sorted_ = np.lexsort((n, key, group))
    row, key, group, n = row[sorted_], key[sorted_], group[sorted_], n[sorted_]
    comp, side = (table.column(c).to_numpy()[row] for c in ("comp", "side"))
    raw = [w for w in table.column("whole").to_pylist()]
    lengths = np.array([len(w) // 8 for w in raw])
    flat = np.frombuffer(b"".join(raw), dtype=np.uint64)
    offsets = (np.cumsum(lengths) - lengths)[row]
    words = lengths[row]
    number = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (key[1:] != key[:-1])]))
    place = number * (1 << 40) + n
    until = np.searchsorted(place, number * (1 << 40) + n * 100 // percent, side="right")
    partners = until - np.arange(len(n)) - 1
    ends = np.cumsum(partners * words)
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_WORDS, side="right")))
        mine = partners[at:to]
        left = np.repeat(np.arange(at, to), mine)
        step = np.arange(len(left)) - np.repeat(np.cumsum(mine) - mine, mine)
        right = left + 1 + step
        ok = (comp[left] != comp[right]) & ((side[left] != side[right]) | (side[left] == 2))
        left, right = left[ok], right[ok]
        apart = np.zeros(len(left), dtype=np.int64)
        for w in np.unique(words[left]):
            own = np.flatnonzero(words[left] == w)
            a = flat[offsets[left[own]][:, None] + np.arange(w)]
            b = flat[offsets[right[own]][:, None] + np.arange(w)]
            times = words[right[own]] // w  # a larger set's sketch is so many times as long
            for part in range(1, int(times.max())):
                more = times > part
                b[more] ^= flat[offsets[right[own]][more][:, None] + part * w + np.arange(w)]
            apart[own] = np.bitwise_count(a ^ b).sum(axis=1)
        near = apart <= (100 - percent) * (n[left] + n[right]) // (100 + percent)
        yield row[left[near]], row[right[near]], apart[near]
        at = to


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of whole groups, as many as fit ``HELD_KEYS`` and ``HELD_BYTES``, or one group."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        group = batch.column("group").to_numpy()
        if not len(group):
            continue
        lengths = batch.column("keys").value_lengths().to_numpy()
        rows, size = rows + int(lengths.sum()), size + batch.nbytes
        cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
        if cut and (rows > HELD_KEYS or size > HELD_BYTES):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows, size = [batch.slice(cut)], int(lengths[cut:].sum()), batch.slice(cut).nbytes
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _candidates(grouped: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (id, hub, apart) with a key in a group whose sketches allow a link between components.

    With ``nearest`` only one of them for each member, the one least apart; else all, whose
    number grows with the square of a group: for a few sets only.  Rows without
    ``keys`` have one key per group.
    """
    if "keys" not in grouped.columns:
        grouped = grouped.withColumn("keys", F.array(F.lit(0).cast("bigint")))

    @handing_back
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            ids, found = table.column("id").to_numpy(), []
            for left, right, apart in _near_pairs(table, percent):
                a, b = np.maximum(ids[left], ids[right]), np.minimum(ids[left], ids[right])
                if nearest:
                    a, b, apart = _firsts(np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([apart, apart]))
                found.append((a, b, apart))
            a, b, apart = (np.concatenate(x) for x in zip(*found))
            if nearest:
                a, b, apart = _firsts(a, b, apart)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(apart)], names=["id", "hub", "apart"])

    found = grouped.mapInArrow(pairs, "id bigint, hub bigint, apart bigint")
    return found if nearest else found.dropDuplicates(["id", "hub"])


def _near_members(grouped: DataFrame, percent: int) -> DataFrame:
    """The rows that have such a pair in their group: at most as many as there are, however many pairs they have."""

    @handing_back
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            near = np.zeros(len(table), dtype=bool)
            for left, right, _ in _near_pairs(table, percent):
                near[left] = near[right] = True
            yield from table.filter(pa.array(near)).to_batches()

    return grouped.mapInArrow(members, grouped.schema)


def _joined_within(near: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (id, hub) that join the components of near members as all links of a group would.

    Pairs are verified on the whole texts, the nearest first, unless earlier links
    have joined their components; so a group gives fewer links than it has members.
    """
    grouped = near.join(texts.withColumnRenamed("doc", "id"), "id").repartition("group").sortWithinPartitions("group", "id")

    @handing_back
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            own = list(distinct_shingles(table.column("text"), k))
            ids, root, found = table.column("id").to_numpy(), Roots(table.column("comp").to_numpy()), []
            for left, right, apart in _near_pairs(table, percent):
                order = np.lexsort((right, left, apart))
                for a, b in zip(left[order].tolist(), right[order].tolist()):
                    if not root.same(a, b) and _similar(own[a], own[b], percent):
                        root.join(a, b)
                        found.append((a, b))
            if found:
                a, b = ids[np.array(found)].T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["id", "hub"]
                )

    return grouped.mapInArrow(links, "id bigint, hub bigint")


class Roots:
    """Which rows of a task have been joined, by their components."""

    def __init__(self, comp: np.ndarray) -> None:
        numbers, self._of = np.unique(comp, return_inverse=True)
        self._of, self._up = self._of.tolist(), list(range(len(numbers)))

    def _root(self, row: int) -> int:
        up, at = self._up, self._of[row]
        while up[at] != at:
            up[at] = at = up[up[at]]
        return at

    def same(self, a: int, b: int) -> bool:
        return self._root(a) == self._root(b)

    def join(self, a: int, b: int) -> None:
        self._up[self._root(a)] = self._root(b)


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted, have the similarity; an empty one has it with none."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    common = int((b[place] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _firsts(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each a the row least apart."""
    order = np.lexsort((b, apart, a))
    a, b, apart = a[order], b[order], apart[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = a[1:] != a[:-1]
    return a[new], b[new], apart[new]


def _torn(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (key, id, n, comp, hub, parts) of keys that are in different components.

    Two similar sets share many keys, so most keys have the members of another one:
    of keys with the same members, by two digests of 64 bits, one is enough.  A key
    with more members than ``PART``, or more shingles than ``PART_SHINGLES``, is to be cut
    into parts.  The hub is the smallest id.  Components only grow together, so what is torn later is among what is torn now.
    """
    members = keys.join(labels, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("comp"))
    torn = members.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("members"), F.min("id").alias("hub"),
        F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("two"),
        F.sum("n").alias("shingles"),
    ).where("low != high").groupBy("one", "two", "members", "hub", "shingles").agg(F.min("key").alias("key"))
    parts = F.ceil(F.greatest(F.col("members") / PART, F.col("shingles") / PART_SHINGLES)).cast("int")
    torn = written(torn.select("key", "hub", parts.alias("parts")), "torn-keys")
    return written(members.join(torn, "key"), "torn-members")


def _grouped(torn: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of torn keys with their sketches, by groups of keys.

    Keys with one hub mostly have the same sets: they go to one group, so that a set's
    sketch comes once for all of them.  A row is a set in a group, with its keys
    there, at most as many as the set has blocks.  A set goes to the group of its
    part of the key with every other part.  Side 2 marks a group of one part.
    """
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = torn.repartition("id").withColumn("own", own).withColumn(
        "beside", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        F.xxhash64("hub", "parts", F.least("own", "beside"), F.greatest("own", "beside")).alias("group"),
        F.when(F.col("own") == F.col("beside"), 2).when(F.col("own") < F.col("beside"), 0).otherwise(1).alias("side"),
        "id", "comp", "key",
    )
    keyed = placed.groupBy("id", "group", "side", "comp").agg(F.collect_set("key").alias("keys"))
    grouped = keyed.join(sets, "id").select("group", "side", "id", "comp", "n", "whole", "keys")
    return grouped.repartition("group").sortWithinPartitions("group", "id")


def _likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (doc, ...) whose id is in ``ids`` (distinct, column doc), and a few others.

    A bit map of hashed ids, of fixed size, is sent to the tasks, so that most other
    rows are not shuffled; a join after it makes the result exact.
    """
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_schema

    bits = 1 << 23
    spot = F.pmod(F.xxhash64("doc"), F.lit(bits))
    maps = ids.groupBy((spot / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg((spot % 32768).cast("bigint")).alias("map")
    )
    flat = np.zeros(bits // 8, dtype=np.uint8)
    for row in maps.collect():  # 1 MB in all
        flat[row.part * 4096 : row.part * 4096 + 4096] = np.frombuffer(row.map, dtype=np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(flat)
    fields = to_arrow_schema(rows.schema)

    @handing_back
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column("spot").to_numpy()
            hit = (shared.value[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1
            found = batch.filter(pa.array(hit.astype(bool)))
            columns = [pc.cast(found.column(f.name), f.type) for f in fields]
            yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    return rows.withColumn("spot", spot).mapInArrow(likely, rows.schema)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts (doc, text) of the documents in ``ids`` (distinct, column doc)."""
    marked = docs.select(F.col("id").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    return _likely(marked, ids).join(ids, "doc")


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose whole sets of shingles have the similarity.

    A hub's text meets its partners' texts in a task, one after the other; hubs
    with many partners are split.
    """
    rows = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    split = rows.select("hub", F.ceil(F.col("n") / 256).cast("int").alias("parts"))
    ids = pairs.select(F.explode(F.array("id", "hub")).alias("doc")).distinct()
    texts = written(_texts(docs, ids), "involved-texts")
    placed = pairs.join(split, "hub").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    partners = placed.select("hub", "part", F.col("id").alias("doc")).join(texts, "doc").select(
        "hub", "part", F.lit(1).alias("role"), "doc", "text"
    )
    hubs = placed.select("hub", "part").distinct().join(texts, F.col("hub") == F.col("doc")).select(
        "hub", "part", F.lit(0).alias("role"), "doc", "text"
    )
    ordered = hubs.unionByName(partners).repartition("hub", "part").sortWithinPartitions("hub", "part", "role")

    @handing_back
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            found_id, found_hub = [], []
            roles, hub_ids, ids = (batch.column(c).to_numpy() for c in ("role", "hub", "doc"))
            for role, hub, doc, own in zip(roles, hub_ids, ids, distinct_shingles(batch.column("text"), k)):
                if role == 0:
                    centre = own
                    continue
                if _similar(own, centre, percent):
                    found_id.append(doc)
                    found_hub.append(hub)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_id, pa.int64()), pa.array(found_hub, pa.int64())], names=["id", "hub"]
            )

    return ordered.mapInArrow(verify, "id bigint, hub bigint")


def jaccard_components(
    docs: DataFrame, percent: int = 85, k: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Components of documents that are linked by similar sets of k-word shingles.

    Two documents link when 100 * common >= percent * all shingles of both.  One
    row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id
    that links reach).  A text without words, or null, has no shingle and no
    link; so has a row with a null id, whose component_id is null.  Rows that
    repeat an id must repeat its text; each has the same answer.  Ids are whole numbers.
    An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    bands = Bands(percent)
    whole = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    named = whole.where(F.col("id").isNotNull())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(_sketches(whole, k, bands, parts), "sketches")
    sets = rows.where(F.col("kind") == SETS).select("id", "n", "sum", "other", "whole")
    real = sets.where("n > 0 AND id IS NOT NULL")

    # Equal sets are one class; a class has links to its smallest id.
    classes = real.groupBy("n", "sum", "other").agg(F.min("id").alias("hub"))
    of_class = real.join(classes, ["n", "sum", "other"]).select("id", "hub", "n").distinct()
    same = of_class.where("id != hub").select("id", "hub")

    packed = rows.where(F.col("kind") == KEYS).select("part", "packed")
    rooms = rows.where(F.col("kind") == ROOMS).select("id", "code", "n")
    needed = written(_needed(written(_shared(packed, parts), "shared-keys"), rooms), "needed-keys")
    stars = needed.where("id != hub").groupBy("id", "hub").agg(F.sum("keys").alias("keys"))
    best = stars.groupBy("id").agg(F.max_by("hub", F.struct("keys", -F.col("hub"))).alias("hub"))
    unlike = best.join(same, ["id", "hub"], "left_anti")
    size = real.select("id", "n").distinct()
    fitting = (
        unlike.join(size.withColumnRenamed("n", "n_id"), "id")
        .join(size.select(F.col("id").alias("hub"), F.col("n").alias("n_hub")), "hub")
        .where(100 * F.least("n_id", "n_hub") >= percent * F.greatest("n_id", "n_hub"))
    )
    first = written(fitting.select("id", "hub"), "star-pairs")
    linked = written(same.unionByName(_verified(named, first, k, percent)), "star-links")
    labels = connected_components(linked)

    # Copies of a set have its keys once for each task that met it; one of them is enough.
    keys = needed.select("key", "id").join(of_class, "id").select("key", F.col("hub").alias("id"), "n").distinct()
    torn = _torn(keys, labels)
    between = torn.select(F.col("id").alias("doc")).distinct()
    sketched = _likely(real.select(F.col("id").alias("doc"), "n", "whole"), between).join(between, "doc")
    sketched = written(sketched.dropDuplicates(["doc"]).withColumnRenamed("doc", "id"), "torn-sets")
    pairs = _candidates(_grouped(torn, sketched), percent, True).groupBy("id").agg(
        F.min_by("hub", F.struct("apart", "hub")).alias("hub")
    )
    chosen = pairs.select(F.greatest("id", "hub").alias("id"), F.least("id", "hub").alias("hub")).distinct()
    chosen = written(chosen, "sketch-pairs")
    if not chosen.isEmpty():
        linked = written(linked.unionByName(_verified(named, chosen, k, percent)), "all-links")
        labels = connected_components(linked)
        torn = _torn(torn.select("key", "id", "n"), labels)
        near = written(_near_members(_grouped(torn, sketched), percent), "near-members")
        texts = _texts(named, near.select(F.col("id").alias("doc")).distinct()).dropDuplicates(["doc"])
        links = written(_joined_within(near, texts, k, percent), "near-links")
        if not links.isEmpty():
            labels = connected_components(linked.unionByName(links))
    # Sizes come with the sets, a row for each of the input.
    return sets.join(labels, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame, percent: int = 85, k: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns as they are.

    Rows with a null id stay, and so do rows that repeat a kept one.  Extra columns may
    have any name.  Ids are whole numbers.  An empty table gives no rows.
    """
    found = jaccard_components(docs, percent, k, id_col, text_col)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct()
    packed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.struct("*").alias("row"))
    return packed.join(gone, "id", "left_anti").select("row.*")
