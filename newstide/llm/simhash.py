"""Near-duplicate documents by 64-bit SimHash with pigeonring filtering.

Two fingerprints that differ in at most ``distance`` bits are linked. The 64 bits are
eight segments on a ring. If all differences sum to at most d, some start on the ring has
the property that every chain of l consecutive segments from there differs in at most
floor(l * d / 8) bits (the pigeonring principle). For d = 3 the budgets are
0 0 1 1 1 2 2 3: the first two segments are equal, and of the next three at least two.

* Equal fingerprints are one class first, so copies never meet in a bucket.
* A class goes under 24 keys: 8 starts, times the 3 choices of two out of the next three
  segments. A pair within the distance shares a key at the start the principle names.
* Within a bucket, a pair is dropped as soon as a chain breaks its budget; only the rest
  have all bits counted. A bucket gives a spanning forest of its links, not its pairs.
* A bucket above ``HOT`` classes is not compared: its members, which agree in 32 bits,
  are dealt out again under 20 keys of half the other 32 bits. Those second buckets hold
  at most 2^16 different fingerprints whatever the input, and are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, fresh, texts, written
from newstide.llm.components import components

SEED = 42
WIDTH = 64
SEGMENTS = 8
#: the largest distance whose pairs are sure to share a key
FARTHEST = 3
#: classes of a bucket that are compared at once; a larger bucket is dealt out again
HOT = 4096
#: rows of a block of pairs
BLOCK = 1024
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_CHOICES = list(combinations((2, 3, 4), 2))


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included.

    A-Z is lower-cased, words are runs without ASCII white space. A text with fewer words
    than a shingle is one shingle; a text without words has the fingerprint 0.
    """
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < shingle else zip(*(words[i:] for i in range(shingle)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), dtype="<u8")
    ones = np.zeros(WIDTH, dtype=np.int64)
    for i in range(0, len(hashes), 65536):  # 64 bytes a shingle: long texts in parts
        part = hashes[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *keep: str) -> DataFrame:
    """The ``keep`` columns of documents and ``fp``, their fingerprint as a signed long."""

    def work(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch)], dtype=np.uint64).view(np.int64)
            yield {**{k: batch.column(k) for k in keep}, "fp": found}

    kept = docs.select(*keep)
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["fp bigint"])
    return by_batch(docs.select(*dict.fromkeys([*keep, "text"])), ddl, work)


def _segment(fp: Column, place: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (place % SEGMENTS)).bitwiseAND(F.lit(255))


def ring_keys(fp: Column) -> Column:
    """The 24 keys of a fingerprint: start, choice, and the four segments that must be equal."""
    keys = []
    for start in range(SEGMENTS):
        for choice, pair in enumerate(_CHOICES):
            key = F.lit(start * len(_CHOICES) + choice).cast("long")
            for step in (0, 1, *pair):
                key = F.shiftleft(key, 8).bitwiseOR(_segment(fp, start + step))
            keys.append(key)
    return F.array(*keys)


def ring_match(xor: np.ndarray, start: int, distance: int = 3) -> np.ndarray:
    """Which differences keep every chain from ``start`` within its budget, all bits included."""
    total, alive = np.zeros(xor.shape, dtype=np.uint8), np.ones(xor.shape, dtype=bool)
    for length in range(1, SEGMENTS + 1):
        place = (start + length - 1) % SEGMENTS
        total += _ONES[(xor >> np.uint64(8 * place)).astype(np.uint8)]
        alive &= total <= distance * length // SEGMENTS
    return alive


class Forest:
    """Which members of a bucket are connected so far."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def bucket_links(members: np.ndarray, start: int | None, distance: int = 3) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints, compared block by block.

    ``start`` names the chain a pair has to hold from; None checks the whole distance
    from every start, for buckets made another way.
    """
    forest, links = Forest(len(members)), []
    for i in range(0, len(members), BLOCK):
        for j in range(i, len(members), BLOCK):
            xor = members[i : i + BLOCK, None] ^ members[None, j : j + BLOCK]
            if start is None:
                near = _ONES[xor.view(np.uint8).reshape(*xor.shape, 8)].sum(-1, dtype=np.uint8) <= distance
            else:
                near = ring_match(xor, start, distance)
            for a, b in zip(*np.nonzero(near)):
                if i + a < j + b and forest.join(int(i + a), int(j + b)):
                    links.append((int(members[i + a]), int(members[j + b])))
    return links


def _parts(width: int, count: int) -> list[int]:
    """Masks of ``count`` parts that together are the low ``width`` bits."""
    cuts = [width * i // count for i in range(count + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def _second_keys(members: np.ndarray, key: int, start: int, choice: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The members of a hot bucket under 20 finer keys each.

    At most three of six parts of the free 32 bits differ, so three parts are equal.
    """
    fixed = {(start + s) % SEGMENTS for s in (0, 1, *_CHOICES[choice])}
    free = [p for p in range(SEGMENTS) if p not in fixed]
    rest = np.zeros(len(members), dtype=np.uint64)
    for n, place in enumerate(free):
        rest |= ((members >> np.uint64(8 * place)) & np.uint64(255)) << np.uint64(8 * n)
    for number, chosen in enumerate(combinations(_parts(32, 6), 3)):
        mask = np.uint64(sum(chosen))
        salt = np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
        mixed = (rest & mask) * np.uint64(0xD6E8FEB86659FD93) ^ salt
        yield mixed.view(np.int64), members


def _groups(batches) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(key, members, closed) of sorted batches.

    A group of more than ``HOT`` members is given in parts, with closed false for all
    parts but the last, so that no more than a batch and ``HOT`` rows are held.
    """
    key, held, cut = None, np.empty(0, dtype=np.uint64), False
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        if key is not None and keys[0] != key:
            if cut or len(held) > 1:
                yield key, held, True
            held, cut = np.empty(0, dtype=np.uint64), False
        # single members in the middle of a batch have nobody to be compared with
        wanted = (ends - starts > 1) | (ends == len(keys))
        wanted[0] = True
        for s, e in zip(starts[wanted], ends[wanted]):
            if s:
                held, cut = np.empty(0, dtype=np.uint64), False
            key, held = int(keys[s]), np.concatenate([held, fps[s:e]])
            if e < len(keys):
                if cut or len(held) > 1:
                    yield key, held, True
            elif len(held) > HOT:
                yield key, held, False
                held, cut = np.empty(0, dtype=np.uint64), True
    if key is not None and (cut or len(held) > 1):
        yield key, held, True


def _compare(distance: int):
    def work(batches):
        hot = None
        for key, members, closed in _groups(batches):
            start, choice = divmod(key >> 32, len(_CHOICES))
            if not closed or hot == key or len(members) > HOT:
                hot = key
                for keys, fps in _second_keys(members, key, start, choice):
                    yield {"key": keys, "a": fps.view(np.int64), "b": fps.view(np.int64)}
                continue
            links = np.array(bucket_links(members, start, distance), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            if len(links):
                yield {"key": [None] * len(links), "a": links[:, 0], "b": links[:, 1]}

    return work


def _compare_all(distance: int):
    """Second buckets: at most 2^16 different members each, gathered and compared in blocks."""

    def work(batches):
        key, parts = None, []
        for found, members, closed in _groups(batches):
            parts = [*parts, members] if found == key else [members]
            key = found
            if closed:
                whole = np.unique(np.concatenate(parts))
                links = np.array(bucket_links(whole, None, distance), dtype=np.uint64).reshape(-1, 2).view(np.int64)
                if len(links):
                    yield {"a": links[:, 0], "b": links[:, 1]}

    return work


def links(classes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (``a``, ``b``) that connect what lies within the distance, from different ``fp``.

    Not every pair: a bucket gives a spanning forest, which keeps every connection. The keys
    hold for a distance of at most ``FARTHEST``; a larger one raises an error.
    """
    if distance > FARTHEST:
        raise ValueError(f"distance {distance}: the keys find every pair up to {FARTHEST} only")
    keyed = classes.select(F.explode(ring_keys(F.col("fp"))).alias("key"), "fp")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = written(by_batch(sorted_keys, "key bigint, a bigint, b bigint", _compare(distance)), "ring")
    again = found.where("key is not null").select("key", F.col("a").alias("fp"))
    finer = again.repartition("key").sortWithinPartitions("key", "fp")
    return (
        found.where("key is null")
        .select("a", "b")
        .unionByName(by_batch(finer, "a bigint, b bigint", _compare_all(distance)))
    )


def grouped(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``fp``, ``root`` and ``component``, the smallest ``doc_id`` reachable over links.

    ``prints`` has ``doc_id`` and ``fp``; null ids only count where a component has no other.
    ``root`` is the same for the fingerprints of a component.
    """
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, distance)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # stored before it is joined back, so that a large component is split over tasks
    least = written(rooted.groupBy("root").agg(F.min("first").alias("component")), "least")
    return rooted.join(least, "root").select("fp", "root", "component")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``.

    Needs columns ``doc_id`` and ``text``; others are not read. Null and empty texts have the
    fingerprint 0 and are linked like any other. Repeated rows give repeated rows. A null
    ``doc_id`` gets the smallest id of its component, null if there is none. An empty table
    gives an empty result.
    """
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle, "doc_id"), "prints")
    return (
        prints.join(grouped(prints, distance), "fp")
        .select("doc_id", "fp", F.col("component").alias("component_id"))
    )


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows, with all columns, that stand for their group of near-duplicates: one of each.

    The row with the smallest ``doc_id`` stays (a null id only where all are null; then, and
    among rows of one id, the smallest hash of the text). Of rows that are equal in id and
    text, one stays.
    """
    hashed = F.xxhash64("text").alias("hash")
    prints = written(fingerprints(docs.select("doc_id", "text", hashed), shingle, "doc_id", "hash"), "prints")
    classes = grouped(prints.withColumn("doc_id", F.col("doc_id").cast("long")), distance)
    # null ids come after all others
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    first = prints.join(classes.select("fp", "root"), "fp").groupBy("root", "doc_id", "hash").agg(F.count("*").alias("n"))
    first = first.groupBy("root").agg(F.min_by(F.struct("doc_id", "hash", "n"), order).alias("w"))
    winners = written(first.select("w.doc_id", "w.hash", "w.n"), "winners")
    parts, winner, winner_hash = [], fresh(docs, "_winner"), fresh(docs, "_winner_hash")
    for repeated in (False, True):
        # stored apart, so that the few repeated rows are known to be few
        chosen = written(winners.where((F.col("n") > 1) == repeated).drop("n"), "winners")
        chosen = chosen.select(F.col("doc_id").alias(winner), F.col("hash").alias(winner_hash))
        own = F.xxhash64(docs["text"])
        met = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col(winner)) & (own == F.col(winner_hash)))
        met = met.dropDuplicates([winner, winner_hash]) if repeated else met
        parts.append(met.select(*(docs[c] for c in docs.columns)))
    return parts[0].unionByName(parts[1])
