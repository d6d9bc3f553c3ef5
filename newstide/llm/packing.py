"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Documents become pieces of at most ``capacity`` tokens. How pieces share sequences only
depends on how many pieces there are of each length, a table of at most ``capacity`` rows
whatever the input. The driver plans on that table and every piece finds its place in the
plan by its rank among the pieces of its length:

* Large items (above a third of the capacity, so at most two fit a sequence) are matched
  greedily: the largest takes the largest partner that fits beside it, all pairs of two
  lengths at once.
* Smaller items, longest first, go where they leave the smallest gap; equal gaps are one
  run of sequences, so that a step of the plan places many items.

Ranks come from counts per task and length, summed by a window over tasks. Pieces with
their ids are written once and never shuffled; only narrow rows are joined.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.llm.bpe import bytes_of_letters
from newstide.llm.common import by_batch, texts, written

#: the token that ends a document
END = 0
#: stands for the end of a word while merging; texts that hold it take the other way
_STOP = "\0"
# characters that the quick way knows: their letters, digits and case are beyond doubt
_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
_UNKNOWN = re.compile(rf"[^\t-\r -~¡£§©«°»¿{_LETTERS}–—‘’“”„•…€]")
# the split of the vocabulary's public description, for those characters
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")


def _merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merges in order of rank, as the vocabulary defines them."""
    while len(symbols) > 1:
        rank, at = min((ranks.get(pair, len(ranks)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
        if rank == len(ranks):
            break
        symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
    return symbols


class WordEncoder:
    """Ids of whole texts by a tokenizers file that merges within lower-cased words.

    Texts of common characters are split here and merged by tiktoken, with the end of a word
    as a byte of its own that joins the last letter first. tiktoken merges any neighbours
    whose concatenation is a token, the file only the pairs it lists. The two are the same
    where every token comes out of merging its own text; tokens that do not are never made by
    the file's pairs, and are left out. All other texts are encoded by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        self.special = [t["content"] for t in found["added_tokens"]]
        model, end = found["model"], found["model"]["end_of_word_suffix"]
        merges = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        letters = bytes_of_letters()
        ranks = {}
        for token, number in model["vocab"].items():
            body = token.removesuffix(end)
            if token in self.special:
                continue
            symbols = [*body[:-1], body[-1] + end] if token.endswith(end) else list(body)
            if _merged(symbols, merges) == [token]:
                ranks[bytes(letters[c] for c in body) + (_STOP.encode() if body != token else b"")] = number
        self.words = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if _UNKNOWN.search(text) or any(name in text for name in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        words = _WORDS.findall(text.lower())
        words.append("")
        return np.array(self.words.encode_ordinary(_STOP.join(words)), dtype="<u4").tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file, made once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary, part int, rank bigint"


def tokenized(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """The pieces of documents, each with the task that made it and its rank there by length."""

    def work(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        encode, end = encoder(path).encode, np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            rows = {name: [] for name in ("doc_id", "piece", "start", "length", "ids", "part", "rank")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    length = len(cut) // 4
                    for name, value in zip(rows, (doc_id, piece, at // 4, length, cut, part, int(seen[length]))):
                        rows[name].append(value)
                    seen[length] += 1
            yield rows

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), PIECES, work)


@dataclass(frozen=True)
class Step:
    """Items of a length from a rank on: ``each`` in every one of ``bins`` sequences."""

    length: int
    rank: int
    first_bin: int
    bins: int
    each: int
    offset: int


class _Gaps:
    """Runs of sequences by the room they have left."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, bins: int) -> None:
        if not bins or not gap:
            return
        if not self.runs.get(gap):
            insort(self.sizes, gap)
            self.runs[gap] = []
        self.runs[gap].append((first, bins))

    def best(self, size: int) -> tuple[int, int, int] | None:
        """Take a run of the smallest gap that holds ``size``."""
        at = bisect_left(self.sizes, size)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, bins = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.sizes[at]
        return gap, first, bins


def plan(counts: dict[int, int], capacity: int = 2048) -> list[Step]:
    """Where the items of each length go; ``counts`` has the number of items by length."""
    steps: list[Step] = []
    left, rank, gaps, bins = dict(counts), dict.fromkeys(counts, 0), _Gaps(), 0

    def place(length: int, first: int, many: int, each: int, offset: int) -> None:
        steps.append(Step(length, rank[length], first, many, each, offset))
        rank[length] += many * each
        left[length] -= many * each

    large = sorted(n for n in counts if 3 * n > capacity)
    for length in reversed(large):
        partners = large[: bisect_left(large, min(length, capacity - length) + 1)]
        while left[length]:
            while partners and left[partners[-1]] < (2 if partners[-1] == length else 1):
                partners.pop()
            partner = partners[-1] if partners else None
            if partner == length:
                many = left[length] // 2
                place(length, bins, many, 2, 0)
            elif partner:
                many = min(left[length], left[partner])
                place(length, bins, many, 1, 0)
                place(partner, bins, many, 1, length)
            else:
                many = left[length]
                place(length, bins, many, 1, 0)
            gaps.add(capacity - length - (partner or 0), bins, many)
            bins += many
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[length]:
            gap, first, many = gaps.best(length) or (capacity, bins, -(-left[length] // (capacity // length)))
            bins = max(bins, first + many)
            each = gap // length
            full = min(many, left[length] // each)
            if full:
                place(length, first, full, each, capacity - gap)
                gaps.add(gap - each * length, first, full)
            else:
                rest, full = left[length], 1
                place(length, first, 1, rest, capacity - gap)
                gaps.add(gap - rest * length, first, 1)
            gaps.add(gap, first + full, many - full)
    return steps


def _placed(ranked: DataFrame, steps: list[Step]) -> DataFrame:
    """``sequence_id`` and ``offset`` of rows with ``length`` and their rank ``nth`` among it."""
    ordered = sorted(steps, key=lambda s: (s.length, s.rank))
    column = {f: np.array([getattr(s, f) for s in ordered], dtype=np.int64) for f in Step.__dataclass_fields__}
    keys = (column["length"] << 48) + column["rank"]
    kept = [f for f in ranked.schema if f.name != "nth"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id bigint, offset bigint"

    def work(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            nth = batch.column("nth").to_numpy(zero_copy_only=False)
            step = np.searchsorted(keys, (length << 48) + nth, side="right") - 1
            beyond, each = nth - column["rank"][step], column["each"][step]
            yield {f.name: batch.column(f.name) for f in kept} | {
                "sequence_id": column["first_bin"][step] + beyond // each,
                "offset": column["offset"][step] + beyond % each * length,
            }

    return by_batch(ranked, ddl, work)


def placed(pieces: DataFrame, narrow: DataFrame, capacity: int = 2048) -> DataFrame:
    """``narrow``, a projection of the stored ``pieces``, with ``sequence_id`` and ``offset``.

    ``narrow`` has to keep ``length``, ``part`` and ``rank``.
    """
    counts = pieces.groupBy("part", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = narrow.join(offsets, ["part", "length"]).withColumn("nth", F.col("before") + F.col("rank"))
    return _placed(ranked.drop("before", "part", "rank"), plan(histogram, capacity))


def pack(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """Pieces of documents with their ids and their place: one row per piece.

    Columns ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit integers), ``sequence_id`` and ``offset``. Needs columns ``doc_id`` and ``text``;
    others are not read. A null or empty text is the end token alone. Repeated rows are packed
    each, a null id stays null, texts of any length are cut and none is dropped; an empty
    table gives an empty result. Equal lengths are interchangeable: ties go by task and row.
    """
    pieces = written(tokenized(docs, path, capacity), "pieces")
    return placed(pieces, pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``: the token ids of every sequence in order.

    A sequence has at most ``capacity`` tokens, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
