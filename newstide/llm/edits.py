"""Document fingerprints that follow edit distance: a randomised embedding by random walks.

A walk reads a text character by character. At step j it writes the character it stands on
and moves on by one if a random bit, shared by all texts and looked up by (j, character),
says so. Two texts' walks part at an edit and soon meet again, so edit distance becomes
Hamming distance between what they wrote. A fingerprint keeps the steps that a hash of j
chooses, ``SAMPLES`` of the 3 * 2^scale steps of a text of up to 2^scale characters, each as
a hex digit that hashes the character (0: past the end). The steps chosen for a longer scale
are among those of a shorter one, so that texts of any two lengths can be compared.

Near texts are found by banding: digits of sampled steps make a band key, texts that share
a key are compared, and a pair counts when the likeness of the whole fingerprints is high
enough. All of a key are compared with its leader first; where that does not connect them,
every pair of the key that is not connected yet is compared too. Strangers share a key by
chance, the more of them the more texts there are: a key has a digit more for each ``FOLD``
times the texts, and there are as many more bands as find near texts equally often.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, texts, written
from newstide.llm.components import components
from newstide.llm.simhash import Forest

SAMPLES = 128
LEAST_SCALE = 4
#: bands, and digits of a band's key, of a table of up to ``PLAIN`` different texts
BANDS = 12
DIGITS = 6
PLAIN = 24_000
#: the largest share of texts of likeness ``NEAR`` that share none of a larger table's keys; those bands miss 0.018 to 0.026
MISSED = 0.01
#: how many times as many texts have keys of a digit more, as strangers agree in about one digit of five
FOLD = 5
#: likeness from which texts are near
NEAR = 0.8
#: rows of the tables of shared random bits; steps use them in turn
PERIOD = 1 << 13
#: walkers below which a walk goes on by itself
FEW = 8
#: classes of a block that are compared at once
BLOCK = 256
_PAST = ord("0")
_DIGITS = np.frombuffer(b"123456789abcdef", dtype=np.uint8)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Moves (0 or 1) and hex digits by step and character class; class 0 is the end."""
    draw = np.random.default_rng(20_240_917)
    moves = draw.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
    digits = np.frombuffer(b"123456789abcdef", dtype=np.uint8)[draw.integers(0, 15, (PERIOD, 256))]
    moves[:, 0], digits[:, 0] = 0, _PAST
    return moves, digits


def scale_of(length: int) -> int:
    return max(LEAST_SCALE, (length - 1).bit_length())


@cache
def steps(scale: int) -> np.ndarray:
    """The steps sampled for a scale, in order; those of a scale hold those of the next."""
    end, found = 3 << scale, []
    for start in range(0, end, 1 << 20):
        step = np.arange(start, min(end, start + (1 << 20)), dtype=np.uint64)
        mixed = (step + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        share = (mixed ^ (mixed >> np.uint64(29))).astype(np.float64) / 2.0**64
        found.append(step[share * end < SAMPLES].astype(np.int64))
    return np.concatenate(found)


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return (points % 251 + 1).astype(np.uint8)


def _finish(out: np.ndarray, own: bytes, at: int, step: int, scale: int) -> None:
    """One walk from where it stands to the end of its text."""
    moves, digits = _tables()
    chosen = steps(scale)
    slot = int(np.searchsorted(chosen, step))
    wanted = [*chosen[slot:].tolist(), -1]
    rows = [memoryview(row) for row in moves]
    n, mask, next_at = len(own), PERIOD - 1, 0
    while at < n and wanted[next_at] >= 0:
        upto = wanted[next_at]
        while step < upto and at < n:
            at += rows[step & mask][own[at]]
            step += 1
        if at < n:
            out[slot + next_at] = digits[step & mask, own[at]]
            next_at += 1


def walks(found: list[str]) -> list[str]:
    """The fingerprints of texts, walked side by side, the longest first."""
    moves, digits = _tables()
    order = sorted(range(len(found)), key=lambda i: -len(found[i]))
    own = [_classes(found[i]) for i in order]
    scales = np.array([scale_of(len(c)) for c in own], dtype=np.int64)
    flat = np.concatenate([x for c in own for x in (c, np.zeros(1, dtype=np.uint8))]) if own else np.empty(0, np.uint8)
    lengths = np.array([len(c) for c in own], dtype=np.int64)
    ends = np.cumsum(lengths + 1) - 1
    at = ends - lengths
    out = [np.full(len(steps(int(s))), _PAST, dtype=np.uint8) for s in scales]
    # walkers of one scale stand together: first walker, last, matrix of digits, its steps
    groups = []
    for scale in sorted(set(scales.tolist())):
        members = np.flatnonzero(scales == scale)
        chosen = steps(scale)
        matrix = np.full((len(members), len(chosen)), _PAST, dtype=np.uint8)
        groups.append([members[0], members[-1] + 1, matrix, dict(zip(chosen.tolist(), range(len(chosen))))])
    events: dict[int, list] = {}
    for group in groups:
        for step, slot in group[3].items():
            events.setdefault(step, []).append((group[0], group[1], group[2], slot))
    active, step, mask = len(own), 0, PERIOD - 1
    while active > FEW:
        standing = at[:active]
        read = flat.take(standing)
        for first, last, matrix, slot in events.get(step, ()):
            if first < active:
                stop = min(last, active)
                matrix[: stop - first, slot] = digits[step & mask].take(read[first:stop])
        standing += moves[step & mask].take(read)
        step += 1
        if not step & 63:
            walking = np.flatnonzero(at[:active] < ends[:active])
            active = int(walking[-1]) + 1 if len(walking) else 0
    for first, last, matrix, _ in groups:
        for i in range(first, last):
            out[i] = matrix[i - first]
    for i in range(active):
        start = ends[i] - lengths[i]
        _finish(out[i], own[i].tobytes(), int(at[i] - start), step, int(scales[i]))
    prints = [""] * len(found)
    for place, i in enumerate(order):
        prints[i] = f"{scales[place]:02x}{out[place].tobytes().decode()}"
    return prints


def fingerprint(text: str) -> str:
    return walks([text])[0]


@cache
def _shared(longer: int, shorter: int) -> np.ndarray:
    """Where the longer scale's first steps are among the shorter scale's."""
    wanted = steps(longer)
    return np.searchsorted(steps(shorter), wanted[wanted < 3 << shorter])


def digits_at(print_: str, scale: int) -> np.ndarray:
    """The digits a text has at the steps of its own or a longer scale."""
    own, digits = int(print_[:2], 16), np.frombuffer(print_[2:].encode(), dtype=np.uint8)
    if own == scale:
        return digits
    full = np.full(len(steps(scale)), _PAST, dtype=np.uint8)
    kept = digits[_shared(scale, own)]
    full[: len(kept)] = kept
    return full


def likeness(a: str, b: str) -> float:
    """The share of sampled steps at which two walks wrote the same, ends left out."""
    if a == b:
        return 1.0
    scale = max(int(a[:2], 16), int(b[:2], 16))
    x, y = digits_at(a, scale), digits_at(b, scale)
    live = (x != _PAST) | (y != _PAST)
    return float((x[live] == y[live]).mean()) if live.any() else 0.0


def fingerprints(frame: DataFrame, of: dict[str, str], alike: dict[str, tuple[str, str]], *keep: str) -> DataFrame:
    """The ``keep`` columns, a fingerprint for each text column, and likenesses among those.

    ``of`` names fingerprint columns by the text column each is made of; ``alike`` names
    columns of likeness (0 to 1) by two fingerprint columns, which it may be the only use of.
    A null text counts as empty. Equal texts have equal fingerprints; the empty text is like
    itself only. Repeated rows give repeated rows, an empty table an empty result.
    """

    def work(batches):
        for batch in batches:
            columns = {name: texts(batch, column) for name, column in of.items()}
            distinct = list(dict.fromkeys(t for c in columns.values() for t in c))
            known = dict(zip(distinct, walks(distinct)))
            prints = {name: [known[t] for t in c] for name, c in columns.items()}
            scores = {name: [likeness(x, y) for x, y in zip(prints[a], prints[b])] for name, (a, b) in alike.items()}
            yield {k: batch.column(k) for k in keep} | prints | scores

    kept = frame.select(*keep)
    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    ddl += [f"`{name}` string" for name in of] + [f"`{name}` double" for name in alike]
    return by_batch(frame.select(*dict.fromkeys([*keep, *of.values()])), ", ".join(ddl), work)


def digits_for(number: int) -> int:
    """The digits of a band key of a table of so many different texts."""
    digits, most = DIGITS, PLAIN
    while most < number:
        digits, most = digits + 1, most * FOLD
    return digits


def bands_for(digits: int) -> int:
    """The least number of bands that leave out no larger share of texts of likeness ``NEAR`` than ``MISSED``."""
    return BANDS if digits <= DIGITS else math.ceil(math.log(MISSED) / math.log1p(-(NEAR**digits)))


@cache
def _picked(scale: int, digits: int = DIGITS) -> np.ndarray:
    """Which of a scale's samples make each band: from steps that a text of the scale reaches.

    A longer key has no sample twice, which would leave it as coarse as a shorter one.
    """
    early, draw = max(1, int(np.searchsorted(steps(scale), 1 << scale))), np.random.default_rng(scale)
    if digits <= DIGITS or early < digits:
        return draw.integers(0, early, (bands_for(digits), digits))
    return np.stack([draw.permutation(early)[:digits] for _ in range(bands_for(digits))])


@cache
def _border(scale: int, digits: int = DIGITS) -> tuple[int, int, np.ndarray]:
    """For texts about as long as a scale's shortest: how many live samples they have, and bands of those.

    The walk of a text of 2^(scale - 1) characters ends near step 2^scale. Of two near texts
    the shorter has 0.8 times the live samples of the longer; 0.7 leaves room for how walks
    vary. The bands are of samples that every text of that many live samples reaches.
    """
    full = int(np.searchsorted(steps(scale), 1 << scale))
    least, most = int(0.7 * full), int(np.ceil(full / 0.7))
    draw = np.random.default_rng([scale, 1])
    return least, most, np.stack([draw.permutation(max(digits, least))[:digits] for _ in range(bands_for(digits))])


def band_keys(print_: str, digits: int = DIGITS) -> list[str]:
    """The band keys of a text at its own scale, and at a border of scales that it is near.

    A band that reaches past the text's end says little. At its own scale it is left out,
    unless that is the least one; a text that has such bands is near its scale's lower
    border, where all bands are of steps that the texts on both sides of it reach.
    """
    own, keys = int(print_[:2], 16), []
    for band, read in enumerate(digits_at(print_, own)[_picked(own, digits)]):
        if own == LEAST_SCALE or (read != _PAST).all():
            keys.append(f"{own}.{band}.{read.tobytes().decode()}")
    for scale in (own, own + 1):
        least, most, bands = _border(scale, digits)
        found = digits_at(print_, scale)
        if scale > LEAST_SCALE and least <= np.count_nonzero(found != _PAST) <= most:
            keys += [f"{scale}-{band}.{read.tobytes().decode()}" for band, read in enumerate(found[bands])]
    return keys


def banded(classes: DataFrame, digits: int) -> DataFrame:
    """``key`` and ``id``: a row for each band key of ``classes``, which have ``id`` and ``fingerprint``."""

    def work(batches):
        for batch in batches:
            found = [band_keys(p, digits) for p in batch.column("fingerprint").to_pylist()]
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), [len(k) for k in found])
            yield {"key": [k for own in found for k in own], "id": ids}

    rows = by_batch(classes.select("id", "fingerprint"), "key string, id bigint", work)
    return rows.select(F.xxhash64("key").alias("key"), "id")


def _by_digit(digits: np.ndarray) -> np.ndarray:
    """A one for each digit that is not past the end: products count equal digits."""
    return (digits[:, :, None] == _DIGITS).astype(np.float32).reshape(len(digits), -1)


def near_pairs(prints: list[str], others: list[str], near: float) -> np.ndarray:
    """Which of ``prints`` (rows) are near which of ``others``, as ``likeness`` has it."""
    found = np.zeros((len(prints), len(others)), dtype=bool)
    by_scale = [{}, {}]
    for side, own in zip(by_scale, (prints, others)):
        for i, p in enumerate(own):
            side.setdefault(int(p[:2], 16), []).append(i)
    for s, rows in by_scale[0].items():
        for t, columns in by_scale[1].items():
            x = np.stack([digits_at(prints[i], max(s, t)) for i in rows])
            y = np.stack([digits_at(others[j], max(s, t)) for j in columns])
            past = (x == _PAST).astype(np.float32) @ (y == _PAST).astype(np.float32).T
            same, live = (_by_digit(x) @ _by_digit(y).T).astype(np.float64), x.shape[1] - past.astype(np.float64)
            found[np.ix_(rows, columns)] = np.divide(same, live, out=np.zeros_like(same), where=live > 0) >= near
    return found


def _blocks(near: float):
    def work(group: pa.Table) -> pa.Table:
        """Links between the groups of one block, those that connect groups not connected yet."""
        rows = group.filter(pc.invert(group["other"]))
        columns = group.filter(group["other"])
        root, other_root = rows["root"].to_pylist(), columns["root"].to_pylist()
        number = {r: i for i, r in enumerate(dict.fromkeys([*root, *other_root]))}
        forest, links = Forest(len(number)), []
        for i, j in np.argwhere(near_pairs(rows["fingerprint"].to_pylist(), columns["fingerprint"].to_pylist(), near)):
            if forest.join(number[root[i]], number[other_root[j]]):
                links.append((root[i], other_root[j]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return work


def _beyond_leaders(shared: DataFrame, verified: DataFrame, roots: DataFrame, own: DataFrame, near: float) -> DataFrame:
    """Links (``a``, ``b``) between roots: pairs that share a key and are not connected by leaders.

    Of two members of a key in different groups, one at least is not in the leader's group:
    those are compared with all members of the key, in blocks, so that a crowded key is many
    tasks. Keys whose members are all like the leader, or all connected, or that have the
    leader and one other, are done.
    """
    crowded = shared.where("members > 2").select("key", "leader", "id")
    unlike = verified.where("not near").select(F.col("a").alias("id"), F.col("b").alias("leader"))
    doubtful = crowded.join(unlike, ["id", "leader"]).select("key").distinct()
    root = F.coalesce("root", "id").alias("root")
    members = crowded.join(doubtful, "key", "left_semi").join(roots, "id", "left").select("key", "leader", "id", root)
    members = written(members, "members")
    leading = F.max(F.when(F.col("id") == F.col("leader"), F.col("root"))).alias("leading")
    mixed = members.groupBy("key").agg(leading, F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    apart = members.join(mixed.select("key", "leading"), "key").withColumn("minor", F.col("root") != F.col("leading"))
    sizes = apart.groupBy("key").agg(F.count_if("minor").alias("minors"), F.count("*").alias("all")).where("minors > 0")
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int").alias(f"n_{c}") for c in ("minors", "all")]
    # stored, so that their sizes are known when the joins with the fingerprints are planned
    placed = written(apart.join(sizes.select("key", *blocks), "key").where("id <> leader"), "apart")
    placed = placed.join(own, "id")
    turn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")
    columns = ["key", "root", "fingerprint"]
    minors = placed.where("minor").select(
        *columns, F.lit(False).alias("other"), (turn % F.col("n_minors")).alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("column"),
    )
    others = placed.select(
        *columns, F.lit(True).alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("n_minors") - 1)).alias("row"), (turn % F.col("n_all")).alias("column"),
    )
    # dealt out by block: else the blocks of a crowded key would follow their key into one task
    place = ["key", "row", "column"]
    compared = minors.unionByName(others).repartition(*place).groupBy(*place)
    return written(compared.applyInArrow(_blocks(near), "a bigint, b bigint"), "beyond")


def near_groups(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """``fingerprint`` and ``group_id``, the smallest ``doc_id`` connected by near texts.

    ``prints`` has ``doc_id`` and ``fingerprint``. Equal fingerprints are one class. A class
    goes under its band keys; whoever shares one is compared with the key's smallest class,
    and then every pair of a key that this has not connected. The work is linear in the size
    of a key of near texts, and grows with the number of those unlike its leader, which longer
    keys keep small in a larger table.
    """
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    # the only step that moves all keys, most of which have one member; two numbers a row, sorted
    key = Window.partitionBy("key")
    keyed = banded(classes, digits_for(classes.count()))
    keyed = keyed.select("key", "id", F.min("id").over(key).alias("leader"), F.count("*").over(key).alias("members"))
    shared = written(keyed.where("members > 1"), "shared")
    pairs = shared.where("id <> leader").select("id", "leader").distinct()
    own = classes.select("id", "fingerprint")
    both = pairs.join(own, "id").join(own.select(F.col("id").alias("leader"), F.col("fingerprint").alias("other")), "leader")

    def verify(batches):
        for batch in batches:
            found = zip(*(batch.column(c).to_pylist() for c in ("id", "leader", "fingerprint", "other")))
            links = [(a, b, likeness(x, y) >= near) for a, b, x, y in found]
            yield {name: [link[i] for link in links] for i, name in enumerate(("a", "b", "near"))}

    verified = written(by_batch(both, "a bigint, b bigint, near boolean", verify), "verified")
    roots = components(verified.where("near").select("a", "b")).withColumnRenamed("node", "id")
    beyond = _beyond_leaders(shared, verified, roots, own, near)
    rooted = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    if not beyond.isEmpty():
        joined = components(beyond).select(F.col("node").alias("root"), F.col("root").alias("joint"))
        rooted = rooted.join(joined, "root", "left").withColumn("root", F.coalesce("joint", "root")).drop("joint")
    # stored before it is joined back, so that a large group is split over tasks
    least = written(rooted.groupBy("root").agg(F.min("first").alias("group_id")), "least")
    return rooted.join(least, "root").select("fingerprint", "group_id")


def _in_stretches(frame: DataFrame, cuts: list[float]) -> DataFrame:
    """``stretch``, the number of cuts at or below ``place``, by binary search."""
    if not cuts:
        return frame.withColumn("stretch", F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    found = Bucketizer(splits=splits, inputCol="place", outputCol="stretch").transform(frame)
    return found.withColumn("stretch", F.col("stretch").cast("int"))


def followed(docs: DataFrame, stretches: int) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text after it by descending ``doc_id``.

    The last is followed by the first; equal ids go by a hash of the text, null ids come last.
    Ids are cut into ``stretches`` by quantiles. A stretch is put in order by one task, and
    the first text of a stretch is also sent to the stretch before it, which it follows.
    """
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e18))
    hashed = F.xxhash64("text")
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # equal ids are spread by the hash as far as a double tells fractions of an id
    own = own.withColumn("hash", hashed).withColumn("place", place + F.pmod("hash", F.lit(1024)) / 1024)
    shares = [i / stretches for i in range(1, stretches)]
    cuts = own.select("place").approxQuantile("place", shares, 0.2 / stretches) if shares else []
    cuts = sorted(set(cuts))
    own = _in_stretches(own, cuts)
    tops = own.groupBy("stretch").agg(F.max(F.struct("place", "doc_id", "hash")).alias("top"))
    found = sorted(tops.collect())  # a row per stretch
    above = {r["stretch"]: found[(i + 1) % len(found)]["stretch"] for i, r in enumerate(found)}
    schema = "stretch int, top struct<place:double,doc_id:bigint,hash:bigint>, above int"
    sent = docs.sparkSession.createDataFrame([(r["stretch"], tuple(r["top"]), above[r["stretch"]]) for r in found], schema)
    marked = own.join(F.broadcast(sent), "stretch", "left")
    is_top = F.struct("place", "doc_id", "hash").eqNullSafe(F.col("top"))
    targets = F.when(is_top, F.array("stretch", "above")).otherwise(F.array("stretch"))
    dealt = marked.select("doc_id", "text", "hash", "place", F.posexplode(targets).alias("copy", "in_stretch"))
    order = Window.partitionBy("in_stretch").orderBy("copy", F.desc("place"), F.desc_nulls_last("doc_id"), F.desc("hash"))
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("copy = 0").drop("copy", "hash", "place", "in_stretch")
