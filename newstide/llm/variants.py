"""Spelling variants: each word's frequent neighbour at one edit, and the form it leads to.

Candidates by asymmetric chunks. Of two words at one edit, the shorter (or either, if equally
long) contributes two disjoint chunks of half its length, one at each end; the longer
contributes its positional grams of that length. An edit falls into one chunk at most, so the
other stands in the longer word: in its place if the edit comes after it, shifted by the
difference of lengths, one at most, if the edit comes before it. Words are joined on equal chunks
and grams within that shift, and every candidate is verified by its edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, texts, written

#: maximal runs of letters, a fixed value
RUN = "[A-Za-zÀ-ÿ]+"
#: a run in so many loses a letter; shortest word, least count, and how much commoner a form is
DROP, SHORTEST, LEAST, COMMONER = 199, 6, 5, 5
#: words a task counts before it hands them on
COUNTED = 400_000

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def dropped(doc_id: int | None, run: str, one_in: int = DROP) -> str:
    """The lower-cased run of a document, without one letter where the hash of both says so."""
    number = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if number % one_in:
        return run
    at = number % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, shortest: int = SHORTEST, one_in: int = DROP) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts; a task counts before anything is shuffled.

    Needs columns ``doc_id`` and ``text``; others are not read. A null text has no words and a null
    id is written as nothing; repeated rows count each.
    """
    find = re.compile(RUN).findall

    def work(batches):
        found: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                own: Counter[str] = Counter()
                for run, n in Counter(find(text)).items():
                    # a run of one letter fewer than a word can never become one
                    if len(run) >= shortest:
                        own[run.translate(_LOWER)] += n
                for run, n in own.items():
                    word = dropped(doc_id, run, one_in)
                    if len(word) >= shortest:
                        found[word] += n
            if len(found) >= COUNTED:
                yield {"word": list(found), "n": list(found.values())}
                found.clear()
        yield {"word": list(found), "n": list(found.values())}

    partial = by_batch(docs.select("doc_id", "text"), "word string, n bigint", work)
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _ends(words: DataFrame, longer_by: int, *columns) -> DataFrame:
    """Words with ``size``, the length of the word they are to meet, and its chunks' ``end`` and ``gram``.

    Of all positional grams of a word those stay that begin within the shift the lengths imply:
    the first, and the one as far from the end as the chunk it is to meet.
    """
    size = (F.length("word") - longer_by).alias("size")
    chunk = F.floor((F.length("word") - longer_by) / 2).cast("int")
    grams = F.array(
        F.struct(F.lit(0).alias("end"), F.substr("word", F.lit(1), chunk).alias("gram")),
        F.struct(F.lit(1).alias("end"), F.substr("word", F.length("word") - chunk + 1, chunk).alias("gram")),
    )
    return words.select(*columns, size, F.inline(grams))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of words at exactly one edit with their counts, each pair once.

    ``words`` has distinct ``word`` of two letters or more and ``n``. A pair that agrees at both ends
    is taken at the first end only. Keys carry the length of the shorter word.
    """
    chunks = _ends(words, 0, F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = F.col("word").alias("b"), F.col("n").alias("n_b")
    grams = _ends(words, 0, *b).unionByName(_ends(words, 1, *b))
    met = chunks.join(grams, ["size", "end", "gram"])
    half = F.floor(F.col("size") / 2).cast("int")
    again = (F.col("end") == 1) & (F.substr("a", F.lit(1), half) == F.substr("b", F.lit(1), half))
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    return met.where(ordered & ~again & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def _followed(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of the forms that follow one another, for words with a form.

    Each round doubles the steps taken; counts grow from form to form, so the chains are short.
    """
    current = written(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = current.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        stepped = written(stepped, "steps")
        if stepped.where("moved").isEmpty():
            return stepped.drop("moved")
        current = stepped.drop("moved")


def variants(docs: DataFrame, least: int = LEAST, commoner: int = COMMONER) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    Words are those of ``counted`` with at least ``least`` occurrences. ``form`` is the near
    word of largest count, of equal ones the first by code points, if it is at least
    ``commoner`` times as frequent; ``root`` follows forms to the last. A table without
    words gives an empty result.
    """
    words = written(counted(docs).where(F.col("n") >= least), "words")
    pairs = near_pairs(words)
    links = pairs.unionByName(
        pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    )
    best = F.min(F.struct((-F.col("n_b")).alias("rank"), "b")).alias("best")
    found = links.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    found = words.join(found, "word", "left").withColumn("form_n", -F.col("best.rank"))
    enough = F.col("form_n") >= commoner * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.b")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    found = written(found, "forms")
    roots = _followed(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
