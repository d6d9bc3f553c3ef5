"""Spelling correction by a dictionary with word frequencies.

A known word stays. Otherwise the most frequent dictionary word one edit away is taken,
else the most frequent one two edits away, else the token itself; of equally frequent
ones the alphabetically last. An edit deletes, inserts or replaces a letter or swaps two
neighbours, and the letters it brings in are a to z, as are those of the dictionary.

Two words within ``k`` edits become equal after at most ``k`` deletions from each, so
those shortened forms are the join key. Words of more than ``LONG`` letters have too many
of them: an edit touches at most two neighbouring parts of a word cut in ``2k + 1``, so one
part is found whole in the other word, moved by at most ``k``; long words are joined by
their parts. No candidate is left out, and a pair is checked once however many keys it
shares.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from newstide.functions.binding import bound
from newstide.operators.rows import exploded

DICTIONARY = "word string, freq bigint"
CORRECTIONS = "token string, corrected string"

#: letters beyond which words are joined by parts
LONG = 16
#: documents whose tokens a task holds as Python strings at once
ROWS = 256


def dictionary(tokens: DataFrame, min_count: float = 1) -> DataFrame:
    """``word, freq`` of the a-to-z words in a column ``tokens`` of arrays."""
    words = exploded(tokens, word=F.col("tokens")).where(F.col("word").rlike("^[a-z]+$"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count)


def _without(word: Column, i: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))


def _positions(word: Column, skip_last: int = 0) -> Column:
    n = F.length(word) - skip_last
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def shortened(word: Column, deletions: int) -> Column:
    """The word and its forms with up to ``deletions`` letters removed, each once."""
    once = bound(word, lambda w: F.transform(_positions(w), lambda i: _without(w, i)))
    every = F.concat(F.array(word), once)
    if deletions == 2:

        def twice(w: Column) -> Column:
            def after(i: Column) -> Column:
                left, right = F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))
                return bound(
                    F.struct(left.alias("l"), right.alias("r")),
                    lambda s: F.transform(
                        _positions(s["r"]), lambda j: F.concat(s["l"], _without(s["r"], j))
                    ),
                )

            return F.flatten(F.transform(_positions(w), after))

        every = F.concat(every, bound(word, twice))
    return F.array_distinct(every)


def _swapped(word: Column) -> Column:
    """All forms with two neighbouring letters exchanged."""

    def swap(i: Column) -> Column:
        return F.concat(
            F.substring(word, F.lit(1), i - 1),
            F.substring(word, i + 1, F.lit(1)),
            F.substring(word, i, F.lit(1)),
            F.substring(word, i + 2, F.length(word)),
        )

    return F.transform(_positions(word, skip_last=1), swap)


def _letters(word: Column) -> Column:
    return F.array_join(F.array_sort(F.split(word, "")), "")


def one_edit(a: Column, b: Column, letters_a: Column, letters_b: Column) -> Column:
    """Whether one edit leads from ``a`` to ``b``; ``levenshtein`` knows all but the swap."""
    swap = (letters_a == letters_b) & F.array_contains(_swapped(a), b)
    return (F.levenshtein(a, b, 1) >= 0) | swap


def two_edits(a: Column, b: Column, letters_a: Column, letters_b: Column) -> Column:
    """Whether at most two edits lead from ``a`` to ``b``.

    Swaps are tried as the first edit, the last or both. A swap keeps the letters, so
    beside it there is one edit in the sorted letters at most (a replaced letter moves and
    counts twice there), which spares most pairs the trial.
    """
    swaps = (
        F.exists(_swapped(a), lambda s: F.levenshtein(s, b, 1) >= 0)
        | F.exists(_swapped(b), lambda s: F.levenshtein(a, s, 1) >= 0)
        | F.arrays_overlap(_swapped(a), _swapped(b))
    )
    return (F.levenshtein(a, b, 2) >= 0) | ((F.levenshtein(letters_a, letters_b, 2) >= 0) & swaps)


def _parts(word: Column, n: int) -> Column:
    """The word cut in ``2n + 1``: keys that name the part, the word's length and its letters."""
    return F.flatten(F.transform(F.array(F.length(word)), lambda length: _pieces(word, length, n, 0)))


def _moved_parts(word: Column, n: int) -> Column:
    """What the parts of words of nearby length would be here, moved by up to ``n`` letters."""
    lengths = F.sequence(F.length(word) - n, F.length(word) + n)
    return F.array_distinct(F.flatten(F.transform(lengths, lambda length: _pieces(word, length, n, n))))


def _pieces(word: Column, length: Column, n: int, reach: int) -> Column:
    parts, keys = 2 * n + 1, []
    for k in range(parts):
        start, end = F.floor(length * k / parts).cast("int"), F.floor(length * (k + 1) / parts).cast("int")
        for move in range(-reach, reach + 1):
            at = start + move
            piece = F.when(at >= 0, F.substring(word, at + 1, end - start))
            keys.append(F.concat_ws("|", F.lit(str(k)), length.cast("string"), piece))
    return F.array(*keys)


def corrections(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``token, corrected`` for the distinct tokens that change."""
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return tokens.select("token", F.col("token").alias("corrected")).where(F.lit(False))
    spark, token = tokens.sparkSession, F.col("token")
    unknown = (
        tokens.select("token")
        .distinct()
        # single characters and numbers are never corrected
        .where((F.length(token) > 1) & ~token.rlike(r"^\p{Nd}+$"))
        # two edits can neither shorten a token further nor remove more foreign characters
        .where(F.length(token) <= longest + 2)
        .where(F.length(F.regexp_replace(token, "[a-z]", "")) <= 2)
        .join(words.select(F.col("word").alias("token")), "token", "left_anti")
    )
    # few bytes but much work per token, so a small number of bytes must not end in one task
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    unknown = unknown.repartition(tasks, "token")
    one = _best(unknown, words, 1, one_edit)
    # only tokens without a correction look further
    two = _best(unknown.join(one, "token", "left_anti"), words, 2, two_edits)
    return one.unionByName(two)


def _best(tokens: DataFrame, words: DataFrame, n: int, check: Callable[..., Column]) -> DataFrame:
    """``token, corrected``: the best dictionary word within ``n`` edits, where there is one."""
    token, word = F.col("token"), F.col("word")
    none = F.array().cast("array<string>")
    # a pair meets by shortened forms if the token is short, else by parts
    token_keys = F.when(F.length(token) > LONG, _moved_parts(token, n)).otherwise(shortened(token, n))
    word_keys = F.concat(
        F.when(F.length(word) <= LONG + n, shortened(word, n)).otherwise(none),
        F.when(F.length(word) > LONG - n, _parts(word, n)).otherwise(none),
    )
    left = exploded(tokens, "token", key=token_keys)
    right = exploded(words, "word", "freq", key=word_keys)
    near = F.abs(F.length(token) - F.length(word)) <= n
    pairs = left.join(right, "key").where(near).select("token", "word", "freq").distinct()
    fits = pairs.where(check(token, word, _letters(token), _letters(word)))
    best = F.max(F.struct("freq", "word"))["word"]
    return fits.groupBy("token").agg(best.alias("corrected"))


@F.arrow_udf(ArrayType(StringType()))
def _replaced(tokens: pa.Array, old: pa.Array, new: pa.Array) -> pa.Array:
    """Each row's tokens with its old ones replaced by new ones, in one pass however many they are."""

    def some(start: int) -> pa.Array:
        rows = zip(*(column.slice(start, ROWS).to_pylist() for column in (tokens, old, new)))
        out = []
        for words, before, after in rows:
            change = dict(zip(before or (), after or ()))
            out.append([change.get(w, w) for w in words] if words and change else words)
        return pa.array(out, pa.list_(pa.string()))

    return pa.concat_arrays([some(start) for start in range(0, max(len(tokens), 1), ROWS)])


def corrected_tokens(docs: DataFrame, changes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Replace changed tokens in the column ``tokens`` of arrays.

    Only distinct tokens per document travel to the join, and only the few changed ones
    come back, as a list per document.
    """
    used = exploded(docs, key, token=F.array_distinct("tokens"))
    lists = (
        used.join(changes, "token")
        .groupBy(key)
        .agg(F.collect_list(F.struct("token", "corrected")).alias("changes"))
    )
    replaced = _replaced("tokens", F.col("changes.token"), F.col("changes.corrected"))
    return docs.join(lists, key, "left").withColumn("tokens", replaced).drop("changes")
