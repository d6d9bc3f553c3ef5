import hashlib
import random

import pytest
from llm_cases import CLASHING, documents, empty
from pyspark.sql import functions as F

from newstide.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(nodes):
    """The root of hashes, and each one's siblings, (left, right) by level."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for first in range(0, len(nodes), 3):
            run = nodes[first : first + 3]
            for at in range(len(run)):
                for i in members[first + at]:
                    paths[i].append(("".join(run[:at]), "".join(run[at + 1 :])))
        members = [sum(members[i : i + 3], []) for i in range(0, len(members), 3)]
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def by_hand(rows):
    """(doc_id, leaf, path, subroot, root) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        doc_id, source, lang, n_chars, text = row
        groups.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n_chars, text)))
    ordered = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for source, leaves in groups.items():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        own[source] = climbed([h for _, h in leaves])
    root, above = climbed([own[s][0] for s in ordered])
    return [
        (doc_id, h, path + above[ordered.index(source)], own[source][0], root)
        for source, leaves in groups.items()
        for (doc_id, h), path in zip(leaves, own[source][1])
    ]


def found_of(frame):
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = merkle.manifest(frame, F.col("source"), merkle.leaf(*row), ["doc_id"])
    assert made.columns == ["doc_id", "leaf", "path", "subroot", "root"]
    return [(r.doc_id, r.leaf, [tuple(p) for p in r.path], r.subroot, r.root) for r in made.collect()]


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def many(sizes, seed=1):
    draw = random.Random(seed)
    rows = [
        (i, source, draw.choice([None, "en", ""]), draw.choice([None, i, -1]), draw.choice([None, "", "é\n😀", "x" * 300]) )
        for source, n in sizes.items()
        for i in draw.sample(range(10 * n), n)
    ]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1}, {"a": 2}, {"a": 3}, {"a": 4}, {"a": 9, "b": 10}, {None: 5, "": 1, "B": 28, "a": 81, "é": 2, "z😀": 3},
        {"a": 243, "b": 244, "c": 730, "d": 1},
    ],
)
def test_trees(spark, sizes):
    rows = many(sizes)
    key = lambda r: (r[1], str(r[0]))
    assert sorted(found_of(spark.createDataFrame(rows, SCHEMA)), key=key) == sorted(by_hand(rows), key=key)


def test_many_rounds_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "WIDTH", 3)
    rows = many({"a": 100, "b": 1, "c": 27, **{f"s{i}": 2 for i in range(12)}})
    key = lambda r: (r[1], str(r[0]))
    assert sorted(found_of(spark.createDataFrame(rows, SCHEMA)), key=key) == sorted(by_hand(rows), key=key)


def test_tables_with_nulls_repeats_and_clashing_columns(spark):
    names = [*CLASHING, "group", "pos", "n", "block", "items", "top", "level_0", "path", "leaf", "subroot", "at", "kept_0"]
    frame = documents(spark).selectExpr("*", *[f"1 as {c}" for c in names if c not in CLASHING])
    rows = [tuple(r) for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    key = lambda r: (r[1], str(r[0]))
    assert sorted(found_of(frame), key=key) == sorted(by_hand(rows), key=key)
    assert found_of(empty(spark)) == []


def test_a_path_leads_to_the_root_from_its_leaf_only(spark):
    rows = many({"a": 50, "b": 7})
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), F.col("source"), merkle.leaf(*row), ["doc_id"])
    kept = made.select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("right"),
                       (merkle.folded(merkle.digest(F.lit("other")), F.col("path")) == F.col("root")).alias("wrong"))
    assert {tuple(r) for r in kept.collect()} == {(True, False)}


def test_a_large_group_is_many_tasks(spark):
    made = spark.range(5000).selectExpr("id as doc_id", "'s' as source", "cast(id as string) as lang")
    ranked = merkle._ranked(
        made.select(F.lit("s").alias("group"), F.col("doc_id").alias("kept_0"), merkle.leaf(F.col("lang")).alias("hash")), ["kept_0"]
    )
    rows = ranked.select("pos", "kept_0", "n").collect()
    assert all(r.pos == r.kept_0 and r.n == 5000 for r in rows) and len(rows) == 5000
