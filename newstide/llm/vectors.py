"""Near-duplicate vectors: spherical k-means cells, blocked cosines, one kept per group.

Only vectors of equal label are compared. A vector is at home in the cell of its nearest
centroid, and a guest in every other cell whose border is within a margin of it, so that a
pair parted by a border still meets: each vector is compared with all vectors of its home
cell. Two unit vectors with cosine c are at most sqrt(2 - 2c) apart, and that margin, the
default, loses no pair.

Equal vectors are one class first. A cell is compared in blocks of at most ``BLOCK`` by
``BLOCK`` classes, so that a crowded cell is many tasks; a block gives counts and a spanning
star per connected part, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, written
from newstide.llm.components import components

COSINE = 0.98
#: the distance of unit vectors of that cosine: no pair is lost at a border
MARGIN = (2 - 2 * COSINE) ** 0.5
BLOCK = 256
#: about how many vectors the centroids are fitted on, and rounds of the fit
SAMPLE = 20_000
ROUNDS = 8
#: vectors of the sample per centroid, at least
PER_CENTROID = 16


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # squares of any finite numbers stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def centroids(vectors: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means: unit centroids that maximise the cosines of their own vectors."""
    own = _unit(vectors)
    found = own[np.random.default_rng(11).permutation(len(own))[:cells]].copy()
    for _ in range(ROUNDS):
        nearest = (own @ found.T).argmax(1)
        order = np.argsort(nearest, kind="stable")
        present, starts = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(own[order], starts)
        norms = np.linalg.norm(sums, axis=1)
        found[present[norms > 0]] = sums[norms > 0] / norms[norms > 0, None]
    return found


def fit(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each dimension, from a bounded sample chosen by hash.

    There are half as many cells as the square root of the number of classes, and at most
    ``SAMPLE / PER_CENTROID``.
    """
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    fitted = {}
    for dim, number in sizes.items():
        scale = 1 << 30
        limit = min(scale, scale * SAMPLE // number)
        chosen = classes.where((F.col("dim") == dim) & (F.pmod("h1", F.lit(scale)) < limit))
        rows = sorted(r[0] for r in chosen.select("embedding").collect())
        cells = max(1, min(int(number**0.5) // 2, len(rows) // PER_CENTROID))
        fitted[dim] = centroids(np.array(rows, dtype=np.float64), cells) if rows else np.zeros((1, dim))
    return fitted


def cells_of(vectors: np.ndarray, centers: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each vector, and which cells it is at home or a guest in."""
    dots = _unit(vectors) @ centers.T
    home = dots.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centers @ centers.T))
    inside = dots[np.arange(len(home)), home][:, None] - dots <= margin * apart[home] + 1e-9
    return home, inside


def _assigned(classes: DataFrame, fitted: dict[int, np.ndarray], margin: float) -> DataFrame:
    """A row per class and cell it is in; ``home`` marks its own cell."""

    def work(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for dim in sorted(set(rows["dim"].to_pylist())):
                part = rows.filter(pa.compute.equal(rows["dim"], dim)).combine_chunks()
                home, inside = cells_of(_matrix(part["embedding"].combine_chunks()), fitted[dim], margin)
                row, cell = np.nonzero(inside)
                taken = part.take(pa.array(row))
                yield {c: taken[c].combine_chunks() for c in ("id", "label", "dim", "mult", "embedding")} | {
                    "cell": cell.astype(np.int32),
                    "home": home[row] == cell,
                }

    kind = classes.schema["embedding"].dataType.simpleString()
    ddl = f"id bigint, label string, dim int, mult bigint, embedding {kind}, cell int, home boolean"
    return by_batch(classes.select("id", "label", "dim", "mult", "embedding"), ddl, work)


def _parts(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id connected with each row and column of a block of links.

    ``linked`` is homes by others, ``ids`` the homes' ids and then the others'.
    """
    homes, others = ids[: len(linked)].copy(), ids[len(linked) :].copy()
    most = np.iinfo(np.int64).max
    while True:
        lower = np.minimum(homes, np.where(linked, others[None, :], most).min(1, initial=most))
        least = np.minimum(others, np.where(linked, lower[:, None], most).min(0, initial=most))
        if (lower == homes).all() and (least == others).all():
            return np.concatenate([homes, others])
        homes, others = lower, least


def _compared(cosine: float):
    def work(group: pa.Table) -> pa.Table:
        """Counts and stars of one block of a cell."""
        group = group.combine_chunks()
        guest = np.array(group["other"].to_pylist(), dtype=bool)
        ids, mult = (group[c].to_numpy() for c in ("id", "mult"))
        vectors = _matrix(group["embedding"].combine_chunks())
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        norms = np.linalg.norm(vectors, axis=1)
        linked = vectors[~guest] @ vectors[guest].T / (norms[~guest, None] * norms[guest]) >= cosine
        # a class is linked with itself whatever rounding says: equal vectors are one class
        linked |= ids[~guest][:, None] == ids[guest]
        order = np.concatenate([ids[~guest], ids[guest]])
        counts = np.concatenate([linked @ mult[guest], np.zeros(guest.sum(), dtype=np.int64)])
        roots = _parts(linked, order)
        keep = (counts > 0) | (roots != order)
        return pa.table({"id": order[keep], "links": counts[keep].astype(np.int64), "root": roots[keep]})

    return work


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, margin: float | None = None) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Needs columns ``vec_id``, ``embedding`` (numbers) and ``label``; others are not read.
    Vectors that are null, zero, or hold null or non-finite components, and vectors without
    a label, link with nothing: they are their own component and kept. Vectors of different
    length are never linked. Repeated rows are each other's links; a null id stays null, its
    component is the smallest id reachable, if any. An empty table gives an empty result.
    The margin is that of the cosine, at which every pair meets, unless another is given.
    """
    margin = max(0.0, 2 - 2 * cosine) ** 0.5 if margin is None else margin
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    own = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string").alias("label"),
        # floats stay floats while they are moved
        F.col("embedding").cast(kind).alias("embedding"),
    )
    good = F.col("label").isNotNull() & usable(F.col("embedding"))
    # two independent hashes tell classes apart without moving vectors again
    hashes = [F.when(good, F.xxhash64(F.lit(i), "label", "embedding")).alias(f"h{i}") for i in (1, 2)]
    keyed = own.select("*", *hashes)
    classes = (
        keyed.where("h1 is not null")
        .groupBy("h1", "h2")
        .agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"),
             F.min("vec_id").alias("first"), F.count("*").alias("mult"))
        .select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("id"))
    )
    classes = written(classes, "vectors")
    cells = written(_assigned(classes, fit(classes), margin), "cells")
    place = ["label", "dim", "cell"]
    sizes = cells.groupBy(place).agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int").alias(f"n_{c}") for c in ("homes", "all")]
    placed = cells.join(sizes.select(*place, *blocks), place)
    turn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")
    columns = [*place, "id", "mult", "embedding"]
    homes = placed.where("home").select(
        *columns, F.lit(False).alias("other"), (turn % F.col("n_homes")).alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("column"),
    )
    others = placed.where("n_homes > 0").select(
        *columns, F.lit(True).alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("n_homes") - 1)).alias("row"), (turn % F.col("n_all")).alias("column"),
    )
    # dealt out by block: else the blocks of a crowded cell would follow their cell into one task
    keys = [*place, "row", "column"]
    compared = homes.unionByName(others).repartition(*keys).groupBy(*keys)
    found = written(compared.applyInArrow(_compared(cosine), "id bigint, links bigint, root bigint"), "cosines")
    counts = found.groupBy("id").agg((F.sum("links") - 1).alias("n_links"))
    roots = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    rooted = classes.select("id", "h1", "h2", "first").join(roots.withColumnRenamed("node", "id"), "id", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "id"))
    # stored before it is joined back, so that a large component is split over tasks
    least = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = rooted.join(least, "root").join(counts, "id").select("h1", "h2", "n_links", "component_id")
    joined = keyed.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
