"""A Merkle manifest of a dataset: one root per group of rows and one over all groups.

The leaves of a group stand in order. Aligned blocks of ``WIDTH`` leaves keep each level of the
tree as one string, the hashes of its nodes one after another; as all hashes are equally
long, the nodes that share a parent are a substring of fixed width, and so are the siblings on
either side of a node. A block is climbed up to its single top; the tops are the leaves of
the next round, and so on up to one node per group. The groups' roots are climbed in the same way.

No group is ever in one task: places are counted within ranges of rows, a block has at most
``WIDTH`` leaves, and what a block learns from above it learns once for all its leaves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newstide.llm.common import written

#: children of a node, levels a block holds, and hence leaves of a block
ARITY, LEVELS = 3, 5
WIDTH = ARITY**LEVELS
#: hex digits of a hash
DIGITS = 64

PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of strings one after another, in UTF-8."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(column: Column) -> Column:
    """A value that cannot run into the next one: its byte count, ``:`` and itself; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The hash of a row's columns."""
    return digest(*map(field, columns))


def folded(hashed: Column, path: Column) -> Column:
    """The root that a leaf's hash and the siblings on its path lead to."""
    return F.aggregate(path, hashed, lambda h, level: digest(level["left"], h, level["right"]))


def proof(path: Column) -> Column:
    """All siblings of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def _ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Leaves with ``pos``, their place in ``group`` from 0, and ``n``, the leaves of the group.

    Rows are sorted by ranges over all tasks, a large group over many; rows of a range and group
    are counted, and what comes before a range is added to the place in it.
    """
    tasks = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.asc_nulls_first(c) for c in ("group", *order, "hash")]
    # copies of a row are spread, too: which of them comes first is all the same
    spread = leaves.withColumn("copy", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(tasks, *by, "copy").sortWithinPartitions(*by, "copy").drop("copy")
    placed = spread.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed, "leaves")
    ranges = placed.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    every = Window.partitionBy("group")
    before = F.sum("rows").over(every.orderBy("part")) - F.col("rows")
    ranges = ranges.select("group", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(every).alias("n"))
    ranges = written(ranges, "ranges")
    return placed.join(ranges, ["group", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "shift", "part")


def _parents(level: Column) -> Column:
    """The level above, as one string: every run of ``ARITY`` nodes, the last perhaps shorter, hashed."""
    run = ARITY * DIGITS
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / run).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * run + 1, F.lit(run)).cast("binary"), 256)), "")


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per block: its items in order, its levels as strings, its top and its height."""
    items = F.array_sort(F.collect_list(F.struct("pos", "hash", *carried)))
    blocks = nodes.groupBy("group", F.floor(F.col("pos") / WIDTH).alias("block")).agg(
        items.alias("items"), F.max("n").alias("n")
    )
    blocks = blocks.withColumn("level_0", F.array_join(F.transform("items", lambda item: item["hash"]), ""))
    unsettled = [F.col("n") > ARITY**level for level in range(LEVELS)]
    for level, more in enumerate(unsettled):
        own = F.col(f"level_{level}")
        blocks = blocks.withColumn(f"level_{level + 1}", F.when(more, _parents(own)).otherwise(own))
    height = sum(more.cast("int") for more in unsettled)
    return blocks.withColumnRenamed(f"level_{LEVELS}", "top").withColumn("height", height)


def _siblings(level: int) -> Column:
    """The substrings on either side of the node above place ``pos`` among those with its parent."""
    own = F.floor((F.col("pos") % WIDTH) / ARITY**level).cast("int")
    first = own - own % ARITY
    text = F.col(f"level_{level}")
    left = F.substr(text, first * DIGITS + 1, (own - first) * DIGITS)
    right = F.substr(text, (own + 1) * DIGITS + 1, (first + ARITY - 1 - own) * DIGITS)
    return F.struct(left.alias("left"), right.alias("right"))


def _climb(nodes: DataFrame, carried: list[str], beyond: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The nodes with ``path``, ``subroot`` and ``root``.

    ``beyond`` takes ``group`` and ``hash``, the single top of every group, and gives for each
    group ``path``, from there on, ``subroot`` and ``root``.
    """
    blocks = written(_blocks(nodes, carried), "blocks")
    if blocks.where(F.col("n") > WIDTH).isEmpty():
        above = beyond(blocks.select("group", F.col("top").alias("hash"))).withColumn("block", F.lit(0).cast("long"))
    else:
        tops = blocks.select(
            "group", F.col("block").alias("pos"), F.col("top").alias("hash"), F.ceil(F.col("n") / WIDTH).alias("n")
        )
        above = _climb(tops, [], beyond).withColumnRenamed("pos", "block").drop("hash", "n")
    above = above.withColumnRenamed("path", "further")
    joined = blocks.join(above, ["group", "block"])
    levels = [f"level_{level}" for level in range(LEVELS)]
    single = joined.select("group", "n", "height", "further", "subroot", "root", *levels, F.inline("items"))
    own = F.slice(F.array(*map(_siblings, range(LEVELS))), F.lit(1), F.col("height"))
    path = F.concat(own, "further").cast(PATH).alias("path")
    return single.select("group", "n", "pos", "hash", *carried, path, "subroot", "root")


def _roots(tops: DataFrame) -> DataFrame:
    """The tree over the groups' tops, in the groups' order."""
    ranked = _ranked(tops.select(F.lit("").alias("group"), F.col("group").alias("of"), "hash"), ["of"])
    nothing = F.array().cast(PATH).alias("path")
    whole = _climb(
        ranked, ["of"], lambda top: top.select("group", nothing, F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    )
    return whole.select(F.col("of").alias("group"), "path", F.col("hash").alias("subroot"), "root")


def manifest(rows: DataFrame, group: Column, hashed: Column, order: list[str], carried: list[str] = ()) -> DataFrame:
    """Each row's place in the tree: ``leaf``, ``path``, ``subroot`` and ``root``.

    Columns of ``order`` and ``carried`` are kept, no others. Rows of one ``group`` (a string,
    null for a group of its own, which comes first; others by their bytes) ascend by ``order``,
    null first, ties by ``hashed``, the row's hash; rows equal in all of these are
    interchangeable. ``path`` has the siblings of every level from the leaf up to the root,
    as strings left and right of the node; a node without siblings is hashed alone. A group
    of one leaf has it as its subroot, a single group its subroot as the root. An empty
    table gives an empty result.
    """
    kept = list(dict.fromkeys([*order, *carried]))
    inner = {name: f"kept_{i}" for i, name in enumerate(kept)}
    key = F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("group")
    leaves = rows.select(key, hashed.alias("hash"), *(F.col(name).alias(to) for name, to in inner.items()))
    found = _climb(_ranked(leaves, [inner[name] for name in order]), list(inner.values()), _roots)
    return found.select(
        *(F.col(to).alias(name) for name, to in inner.items()), F.col("hash").alias("leaf"), "path", "subroot", "root"
    )
