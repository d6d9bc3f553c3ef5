"""Language of a text by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one machine word per slot, with one bit per language. An
n-gram sets its languages' bits in ``HASHES`` slots; looking it up is the bitwise AND of
those slots, which names all languages that contain the n-gram at once. Over a text, each
language's bit is counted (a population count per language), its false positives are taken
off (a bit is set in all slots by chance with probability fill^HASHES), and the language
with the largest corrected share decides.

Learning counts n-grams in a bounded, hash-chosen sample of labelled texts per language;
the texts of a sample are distinct, so that copies do not weigh.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, filtered, texts, written

UNKNOWN = "und"
#: lengths of the n-grams, in characters of a text whose non-letters are blanks
SIZES = (2, 3, 4)
HASHES = 3
SLOTS = 1 << 18
#: about how many texts per language are learned from, and how many n-grams are kept
SAMPLE_TEXTS = 500
SAMPLE_GRAMS = 12_000
#: an n-gram belongs to a language if so many of its sampled texts hold it
LEAST_SHARE = 0.01
#: bits of a word of a slot; a slot has as many words as the languages need
BITS = 64
#: share of a text's n-grams that its language must hold for the text to be accepted
LEAST_COVERAGE = 0.3
#: characters worked on at once
STRETCH = 1 << 19
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@cache
def _letters() -> np.ndarray:
    """Which code points are letters or marks on them."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), dtype=bool, count=0x110000)


def _points(text: str) -> np.ndarray:
    """Code points of the lower-cased text between blanks, with a blank for each non-letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(_letters()[points], points, np.uint32(32))


def _hashes(points: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the n-grams of a size; those that span a blank inside are left out."""
    last = len(points) - size + 1
    if last < 1:
        return np.empty(0, dtype=np.uint64)
    letter, keep = points != 32, np.ones(last, dtype=bool)
    for i in range(size):
        if 0 < i < size - 1 or size == 2:
            keep &= letter[i : last + i]
    at = np.flatnonzero(keep)
    value = np.full(len(at), size, dtype=np.uint64)
    for i in range(size):
        value = value * _FACTOR + points[at + i]
    for step, factor in zip((30, 27), _MIX):
        value = (value ^ (value >> np.uint64(step))) * factor
    return value ^ (value >> np.uint64(31))


def grams(text: str) -> np.ndarray:
    """The hashes of all n-grams of a text, repeats included."""
    points = _points(text)
    return np.concatenate([_hashes(points, size) for size in SIZES])


def _slots(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of each hash: the filter's hash functions are bit ranges of one hash."""
    for i in range(HASHES):
        yield ((hashes >> np.uint64(20 * i)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass
class Filters:
    """The learned filter: ``slots`` of language bits, and the share of slots set per language."""

    languages: list[str]
    slots: np.ndarray

    @classmethod
    def of(cls, members: dict[str, np.ndarray]) -> Filters:
        languages = sorted(members)
        slots = np.zeros((max(1, -(-len(languages) // BITS)), SLOTS), dtype=np.uint64)
        for bit, language in enumerate(languages):
            for at in _slots(members[language]):
                slots[bit // BITS, at] |= np.uint64(1 << bit % BITS)
        return cls(languages, slots)

    @property
    def chance(self) -> np.ndarray:
        """The probability that an n-gram a language lacks is found in it."""
        bits = [(self.slots[b // BITS] >> np.uint64(b % BITS)) & np.uint64(1) for b in range(len(self.languages))]
        return np.array([float(b.mean()) for b in bits]) ** HASHES

    def found(self, hashes: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as bits of one or more words."""
        first, *rest = _slots(hashes)
        masks = self.slots.take(first, axis=1)
        for at in rest:
            masks &= self.slots.take(at, axis=1)
        return masks

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """How many n-grams each language holds, and how many there are."""
        total, number = np.zeros(len(self.languages), dtype=np.int64), 0
        points = _points(text)
        for size in SIZES:
            for start in range(0, len(points), STRETCH):  # an n-gram belongs to where it begins
                masks = self.found(_hashes(points[start : start + STRETCH + size - 1], size))
                number += masks.shape[1]
                for bit in range(len(total)):
                    total[bit] += np.count_nonzero(masks[bit // BITS] & np.uint64(1 << bit % BITS))
        return total, number

    def predict(self, text: str, chance: np.ndarray) -> tuple[str, float, float]:
        """Language, score and the corrected share of n-grams it holds.

        The score is the best share against the second best. A text without letters, or a
        filter without languages, gives ``und`` with score 0; ties go to the first language.
        """
        if not self.languages or not any(map(str.isalpha, text)):  # marks alone are no letter
            return UNKNOWN, 0.0, 0.0
        counts, number = self.counts(text)
        if not number:
            return self.languages[0], 0.0, 0.0
        share = np.clip((counts / number - chance) / (1 - chance), 0, 1)
        best = int(share.argmax())
        rest = np.delete(share, best).max(initial=0)
        return self.languages[best], float(share[best] / (share[best] + rest)) if share[best] else 0.0, float(share[best])


def _gram_rows(batches):
    for batch in batches:
        langs, hashes = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
            own = np.unique(grams(text)).view(np.int64)
            langs += [lang] * len(own)
            hashes.append(own)
        yield {"lang": langs, "gram": np.concatenate(hashes) if hashes else []}


def learn(docs: DataFrame, learned: Column | None = None) -> Filters:
    """Filters from ``text`` and ``lang`` of the rows where ``learned`` holds (default: all).

    Rows with a null text or language are not learned from. What reaches the driver is
    bounded: a count per language, and ``SAMPLE_GRAMS`` n-grams of each.
    """
    usable = F.col("text").isNotNull() & F.col("lang").isNotNull()
    usable = usable if learned is None else usable & F.coalesce(learned, F.lit(False))
    known = docs.where(usable).select("lang", "text", F.xxhash64("text").alias("hash"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    if not sizes:
        return Filters.of({})
    scale = 1 << 30
    limit = F.create_map(*(F.lit(x) for l, n in sizes.items() for x in (l, min(scale, scale * SAMPLE_TEXTS // n))))
    sample = known.where(F.pmod("hash", F.lit(scale)) < limit[F.col("lang")]).dropDuplicates(["lang", "hash"])
    counted = by_batch(sample.select("lang", "text"), "lang string, gram bigint", _gram_rows).groupBy("lang", "gram").count()
    share = F.create_map(*(F.lit(x) for l, n in sizes.items() for x in (l, LEAST_SHARE * min(n, SAMPLE_TEXTS))))
    often = counted.where((F.col("count") >= share[F.col("lang")]) & ((F.col("count") > 1) | (share[F.col("lang")] < 1)))
    often = written(often, "grams")
    members = {}
    for language in sorted(sizes):
        top = often.where(F.col("lang") == language).orderBy(F.desc("count"), "gram").limit(SAMPLE_GRAMS)
        members[language] = np.array([r["gram"] for r in top.select("gram").collect()], dtype=np.int64).view(np.uint64)
    return Filters.of(members)


def predict(docs: DataFrame, filters: Filters, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``lang_pred``, ``score`` (0 to 1), ``coverage`` of every row.

    Only ``text`` decides. A null text, or one without letters, is ``und`` with score 0;
    repeated rows give repeated rows, an empty table an empty result. ``coverage`` is the
    share of the text's n-grams that the language holds, false positives taken off.
    """

    def work(batches):
        chance = filters.chance
        for batch in batches:
            found = [filters.predict(t, chance) for t in texts(batch)]
            language, score, coverage = zip(*found) if found else ((), (), ())
            yield {k: batch.column(k) for k in keep} | {
                "lang_pred": language,
                "score": score,
                "coverage": coverage,
            }

    kept = docs.select(*keep)
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return by_batch(
        docs.select(*dict.fromkeys([*keep, "text"])), ddl + "lang_pred string, score double, coverage double", work
    )


def accepted(docs: DataFrame, filters: Filters, least: float = LEAST_COVERAGE) -> DataFrame:
    """The rows, with all columns, whose text is in a learned language.

    Rejected are texts that are null or without letters, and texts of whose n-grams no
    learned language holds the share ``least``. Repeated rows are judged alike.
    """

    def judge(own: list[str]) -> list[bool]:
        chance = filters.chance
        found = [filters.predict(t, chance) for t in own]
        return [language != UNKNOWN and coverage >= least for language, _, coverage in found]

    return filtered(docs, judge)
