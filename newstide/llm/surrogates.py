"""Personal data replaced by keyed stand-ins of the same type, over a whole table.

The same entity gets the same stand-in in every document (coreference), different entities
get different ones, and none is the name of an entity that occurs (distinctness). A first
pass finds the entities; stand-ins of the first attempt are checked against all entities and
against each other in rounds of joins, and those that clash try again. A second pass writes
the texts: first attempts are made on the spot from the key, and only documents that name an
entity with a later attempt are joined with a table of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, fresh, texts, written
from newstide.llm.entities import CLOSED, listed, mentions, pool, rendered, stand_in

#: rounds after which names of a format are given up for lost
ATTEMPTS = 60


def entities(docs: DataFrame) -> DataFrame:
    """``hash`` of the text, ``kind`` and ``normal``: the entities each text names, once per batch."""

    def work(batches):
        for batch in batches:
            found = {
                (number, m.kind, m.normal)
                for number, text in zip(batch.column("hash").to_pylist(), texts(batch))
                for m in mentions(text)
            }
            rows = sorted(found)
            yield {name: [r[i] for r in rows] for i, name in enumerate(("hash", "kind", "normal"))}

    named = docs.where("text is not null").select(F.xxhash64("text").alias("hash"), "text")
    return by_batch(named, "hash bigint, kind string, normal string", work)


def _made(named: DataFrame, key: bytes) -> DataFrame:
    """Stand-ins for entities at their attempt; closed lists keep names apart themselves."""

    def work(batches):
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("kind", "normal", "attempt")}
            rows = list(zip(*columns.values()))
            yield columns | {
                "stand_in": [stand_in(k, n, key, a) for k, n, a in rows],
                "listed": [a == CLOSED or listed(k, n) for k, n, a in rows],
            }

    return by_batch(named, "kind string, normal string, attempt int, stand_in string, listed boolean", work)


def _formats(named: DataFrame) -> DataFrame:
    """Entities with their format and its number of values, if that is a fixed one."""

    def work(batches):
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("kind", "normal")}
            pools = [pool(*row) or (None, None) for row in zip(*columns.values())]
            yield columns | {"format": [f for f, _ in pools], "values": [None if n is None else float(n) for _, n in pools]}

    return by_batch(named, "kind string, normal string, format string, values double", work)


def _first(known: DataFrame) -> DataFrame:
    """Entities with their first attempt: ``CLOSED`` where more than a third of a format's values occur, else 0.

    In a fuller format too few values are left for each entity to draw a free one of its own.
    """
    formats = known.where("format is not null").groupBy("kind", "format")
    full = formats.agg(F.count("*").alias("n"), F.max("values").alias("most")).where("3 * n > most")
    # few rows: a format of many values takes many entities to fill
    full = F.broadcast(full.select("kind", "format", F.lit(CLOSED).alias("attempt")))
    return known.join(full, ["kind", "format"], "left").select("kind", "normal", F.coalesce("attempt", F.lit(0)).alias("attempt"))


def assigned(found: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``normal``, ``attempt`` and ``stand_in`` of every entity, without clashes."""
    known = written(_formats(found.select("kind", "normal").distinct()), "entities")
    waiting, done = _first(known), None
    for _ in range(ATTEMPTS):
        made = written(_made(waiting, key), "stand-ins")
        taken = known.select("kind", F.col("normal").alias("stand_in"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "stand_in"))
        free = made.where("not listed").join(taken, ["kind", "stand_in"], "left_anti")
        first = free.groupBy("kind", "stand_in").agg(F.min("normal").alias("normal"), F.max("attempt").alias("attempt"))
        columns = ["kind", "normal", "attempt", "stand_in"]
        settled = first.select(columns).unionByName(made.where("listed").select(columns))
        done = written(settled if done is None else done.unionByName(settled), "assigned")
        waiting = made.select("kind", "normal", "attempt").join(done, ["kind", "normal"], "left_anti")
        waiting = written(waiting.withColumn("attempt", F.col("attempt") + 1), "waiting")
        if waiting.isEmpty():
            return done
    raise RuntimeError("some entities found no stand-in of their own: their format has too few values")


_SPANS = "array<struct<start:int,end:int,kind:string,stand_in:string>>"


def _replaced(text: str, key: bytes, later: dict[tuple[str, str], int]) -> tuple[str, list[dict]]:
    """The text with stand-ins, and where they stand in it."""
    parts, spans, at, length = [], [], 0, 0
    for m in mentions(text):
        made = stand_in(m.kind, m.normal, key, later.get((m.kind, m.normal), 0))
        put = rendered(text[m.start : m.end], m.kind, made)
        parts += [text[at : m.start], put]
        length += m.start - at
        spans.append({"start": length, "end": length + len(put), "kind": m.kind, "stand_in": put})
        length, at = length + len(put), m.end
    return "".join([*parts, text[at:]]), spans


def surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """All columns of ``docs`` with personal data in ``text`` replaced, and ``_spans``.

    ``_spans`` lists the stand-ins by their place in the new text, their kind and their
    letters. Only ``text`` is read; a null text stays null with null spans, a text without
    entities is returned as it is with no spans. Repeated rows are treated alike; an empty
    table gives an empty result. A column of the input named ``_spans`` is replaced.
    """
    found = written(entities(docs), "mentions")
    later = assigned(found, key).where("attempt != 0").select("kind", "normal", "attempt")
    affected = found.distinct().join(later, ["kind", "normal"])
    hashed, tried = fresh(docs, "_hash"), fresh(docs, "_later")
    retried = F.collect_list(F.struct("kind", "normal", "attempt")).alias(tried)
    # stored, so that its size is known when the join with the texts is planned
    retries = written(affected.groupBy(F.col("hash").alias(hashed)).agg(retried), "retries")
    plain = docs.drop("_spans").withColumn(hashed, F.xxhash64("text")).join(retries, hashed, "left").drop(hashed)
    columns = [c for c in plain.columns if c not in ("text", tried)]

    def work(batches):
        for batch in batches:
            new, spans = [], []
            for text, again in zip(*(batch.column(c).to_pylist() for c in ("text", tried))):
                tries = {(r["kind"], r["normal"]): r["attempt"] for r in again or ()}
                made = (None, None) if text is None else _replaced(text, key, tries)
                new.append(made[0])
                spans.append(made[1])
            yield {c: batch.column(c) for c in columns} | {"text": new, "_spans": spans}

    kept = docs.drop("_spans").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `_spans` {_SPANS}"
    return by_batch(plain, ddl, work)
