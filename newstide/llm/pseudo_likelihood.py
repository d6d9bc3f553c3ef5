"""Scores of texts by masked pseudo-likelihood: every word is predicted from both sides.

Words are hashed to buckets, as many as the corpus has different words. A network reads the
vectors of the ``SIDE`` words before and after a masked one through a hidden layer and gives
the probability of the word in two steps, each a softmax: that of its group of ``GROUP``
buckets, and that of the word in the group. A text's score is the sum of log P(word | both
sides) over all its words.

The buckets are counted over the whole corpus; the counts are where the network's biases
start. It is trained on every position of all texts: the number of trainers grows with the
corpus, tasks that each take texts of about ``TRAINER`` positions from everywhere, go over
them from the same start, and hand on what they changed. The changes of a row are averaged
over the trainers that touched it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, crc_hash

#: buckets at most, which bounds the network a worker holds; beyond, words share buckets
MOST = 1 << 16
GROUP = 256
SIDE = 2
#: width of a word's vector and of the hidden layer
VECTOR, HIDDEN = 8, 16
WIDTH = VECTOR + HIDDEN + 1
#: positions to learn from: one in so many (1: all), a least number, and how many a trainer takes
SHARE, LEAST, TRAINER = 1, 1 << 17, 1 << 22
#: passes over them, steps at least, positions a step at least and at most, and its size
PASSES, STEPS, MINIBATCH, LARGE, STEP = 1, 100, 2048, 1 << 15, 0.15
#: no parameter is larger, so that no probability overflows
LARGEST = 5.0
#: the column that holds a text's buckets, two bytes each, least first
WORDS = "word_buckets"
#: rows of the network changed at once, which keeps them near the processor
ROWS = 4096
#: words whose buckets a worker remembers, words scored at once, and rows of scores at once
CACHE, SCORED, BLOCK = 250_000, 1 << 16, 128


class _Buckets(dict):
    """The bucket of a word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = bucket = crc_hash(word) % MOST
        return bucket


_BUCKETS = _Buckets()


def buckets(text: str) -> np.ndarray:
    """The bucket of each word of a text, of ``MOST``."""
    words = text.lower().split()
    return np.fromiter(map(_BUCKETS.__getitem__, words), dtype=np.int64, count=len(words))


def _all_buckets(given: pa.Array) -> list[np.ndarray]:
    """The buckets of each text of a column, null as empty; each different word of it is hashed once."""
    split = pc.utf8_split_whitespace(pc.fill_null(given.cast(pa.large_string()), ""))
    if isinstance(split, pa.ChunkedArray):
        split = split.combine_chunks()
    words = split.flatten().dictionary_encode()
    own = [crc_hash(w.lower()) % MOST if w else -1 for w in words.dictionary.to_numpy(zero_copy_only=False)]
    found = np.array(own, dtype=np.int64)[words.indices.to_numpy()] if own else np.empty(0, dtype=np.int64)
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
    # a space at either end leaves an empty piece there
    return [x[x >= 0] for x in np.split(found, ends[:-1])] if len(ends) else []


def worded(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the buckets of ``text``, for all steps to read instead of the text."""

    def work(batches):
        for batch in batches:
            found = _all_buckets(batch.column("text"))
            yield {"doc_id": batch.column("doc_id"), WORDS: [x.astype("<u2").tobytes() for x in found]}

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), f"doc_id bigint, {WORDS} binary", work)


def _given(docs: DataFrame) -> str:
    return WORDS if WORDS in docs.columns else "text"


def _found(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The buckets of a batch's texts, made before or here."""
    if WORDS not in batch.schema.names:
        return _all_buckets(batch.column("text"))
    return [np.frombuffer(x or b"", dtype="<u2").astype(np.int64) for x in batch.column(WORDS).to_pylist()]


def _in_stretches(found: list[np.ndarray], most: int = 1 << 18):
    """Texts in groups of about so many words; a longer text is a group of its own."""
    group, size = [], 0
    for own in found:
        if group and size + len(own) > most:
            yield group
            group, size = [], 0
        group.append(own)
        size += len(own)
    if group:
        yield group


def word_counts(docs: DataFrame) -> np.ndarray:
    """How often a word of each bucket occurs in all documents."""

    def work(batches):
        total = np.zeros(MOST, dtype=np.int64)
        for batch in batches:
            for group in _in_stretches(_found(batch)):
                total += np.bincount(np.concatenate(group), minlength=MOST)
        seen = np.flatnonzero(total)
        yield {"bucket": seen, "n": total[seen]}

    rows = by_batch(docs.select(_given(docs)), "bucket bigint, n bigint", work)
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(MOST, dtype=np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


@dataclass
class Vocabulary:
    """The place of each bucket by frequency, the most frequent first, and the counts by place."""

    places: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        """Buckets are folded to the least power of two that is not below those in use."""
        size = GROUP
        while size < min(MOST, np.count_nonzero(counts)):
            size *= 2
        folded = counts.reshape(-1, size).sum(0)
        order = np.argsort(-folded, kind="stable")
        places = np.empty(size, dtype=np.int32)
        places[order] = np.arange(size)
        return cls(places, folded[order])

    def __len__(self) -> int:
        return len(self.places)

    def ids(self, found: np.ndarray) -> np.ndarray:
        return self.places[found & (len(self) - 1)]

    def contexts(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For texts as buckets: the ids on both sides of each word, and its own; ``len(self)`` is beyond an end."""
        gap = np.full(SIDE, len(self), dtype=np.int32)
        line = np.concatenate([gap, *(x for own in found for x in (self.ids(own), gap))])
        own = np.flatnonzero(line[SIDE : len(line) - SIDE] < len(self)) + SIDE
        around = [offset for offset in range(-SIDE, SIDE + 1) if offset]
        return np.stack([line[own + offset] for offset in around], axis=1), line[own]


class Room(dict):
    """Arrays by name that one step after the other uses: memory taken anew costs time of its own."""

    def __call__(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = prod(shape)
        if name not in self or len(self[name]) < size or self[name].dtype != dtype:
            self[name] = np.empty(size, dtype=dtype)
        return self[name][:size].reshape(shape)


class Network:
    """All parameters in one matrix: a row per word (vector, weights, bias), the end's vector,
    a row per group (weights, bias), then the hidden layer's."""

    def __init__(self, counts: np.ndarray, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.words, self.groups = len(counts), len(counts) // GROUP
        inner = (2 * SIDE * VECTOR + 1) * HIDDEN
        self.layer = self.words + 1 + self.groups
        own = draw.normal(0, 0.1, (self.layer + -(-inner // WIDTH), WIDTH)).astype(np.float32)
        own[: self.words + 1, :VECTOR] *= 3
        own[self.layer :] *= 2
        mass = np.maximum(counts, 0.5).reshape(self.groups, GROUP)
        own[: self.words, -1] = np.log(mass / mass.sum(1, keepdims=True)).ravel()
        own[self.words + 1 : self.layer, -1] = np.log(mass.sum(1) / mass.sum())
        self.own = own

    def parts(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Views of a matrix like ``own``: vectors, words' and groups' weights with bias, hidden layer with bias."""
        flat = matrix[self.layer :].reshape(-1)[: (2 * SIDE * VECTOR + 1) * HIDDEN]
        groups = matrix[self.words + 1 : self.layer, VECTOR:]
        return matrix[:, :VECTOR], matrix[: self.words, VECTOR:], groups, flat.reshape(-1, HIDDEN)

    def hidden(self, sides: np.ndarray, room: Room | None = None) -> tuple[np.ndarray, np.ndarray]:
        room = Room() if room is None else room
        vectors, _, _, inner = self.parts(self.own)
        table = room("table", vectors.shape, vectors.dtype)
        table[:] = vectors
        # ids are all in range; without "clip" there would be another copy
        seen = table.take(sides, axis=0, out=room("seen", (*sides.shape, VECTOR), table.dtype), mode="clip")
        seen = seen.reshape(len(sides), -1)
        hidden = np.matmul(seen, inner[:-1], out=room("hidden", (len(seen), HIDDEN), table.dtype))
        hidden += inner[-1]
        return seen, np.tanh(hidden, out=hidden)

    @staticmethod
    def _by_group(own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order that puts words of a group together, and each group that occurs with its stretch of that order."""
        group = (own // GROUP).astype(np.int16)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        return order, list(zip(group[order[starts]].tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]))

    @staticmethod
    def _with_ones(matrix: np.ndarray, room: Room) -> np.ndarray:
        """A column of ones beside a matrix: products with it add biases, or sum."""
        beside = room("with ones", (len(matrix), matrix.shape[1] + 1), matrix.dtype)
        beside[:, :-1], beside[:, -1] = matrix, 1
        return beside

    def logs(self, sides: np.ndarray, own: np.ndarray, room: Room | None = None) -> np.ndarray:
        """log P(word | both sides) of each word."""
        room = Room() if room is None else room
        _, words, groups, _ = self.parts(self.own)
        order, stretches = self._by_group(own)
        own, given = own[order], self._with_ones(self.hidden(sides.take(order, axis=0), room)[1], room)
        found, totals = np.zeros((2, len(own)), dtype=given.dtype)
        number = np.arange(BLOCK)

        def chances(rows, stretches, target):
            """log softmax at the targets, a block at a time in the same scratch, which stays near the processor."""
            scratch = np.empty((BLOCK, rows.shape[1]), dtype=rows.dtype)
            ones = np.ones(rows.shape[1], dtype=rows.dtype)
            for group, start, end in stretches:
                across = rows[group].T.copy()
                for at in range(start, end, BLOCK):
                    stop = min(at + BLOCK, end)
                    scores = np.matmul(given[at:stop], across, out=scratch[: stop - at])
                    found[at:stop] += scores[number[: stop - at], target[at:stop]]
                    np.matmul(np.exp(scores, out=scores), ones, out=totals[at:stop])
            np.subtract(found, np.log(totals), out=found)

        chances(groups[None], [(0, 0, len(own))], own // GROUP)
        chances(words.reshape(self.groups, GROUP, -1), stretches, own % GROUP)
        placed = np.empty_like(found)
        placed[order] = found
        return placed

    def slopes(self, sides: np.ndarray, own: np.ndarray, room: Room | None = None) -> np.ndarray:
        """The slope of -sum(logs) in every parameter; it stands in ``room`` until that is used again."""
        room = Room() if room is None else room
        _, words, groups, inner = self.parts(self.own)
        kind = self.own.dtype
        slope = room("slope", self.own.shape, kind)
        slope.fill(0)
        to_vectors, to_words, to_groups, to_inner = self.parts(slope)
        order, stretches = self._by_group(own)
        sides, own = sides.take(order, axis=0), own[order]
        seen, hidden = self.hidden(sides, room)
        given, back = self._with_ones(hidden, room), room("back", hidden.shape, kind)
        back.fill(0)
        sums = room("sums", given.shape, kind)

        def softmax(rows, to_rows, stretches, target):
            """A block at a time in the same scratch, as in ``logs``; sums are divided, not every chance."""
            scratch = np.empty((BLOCK, rows.shape[1]), dtype=rows.dtype)
            line, first = scratch.reshape(-1), np.arange(BLOCK) * rows.shape[1]
            beside = np.empty(rows.shape[1:], dtype=rows.dtype)
            across = np.empty(rows.shape[:0:-1], dtype=rows.dtype)
            for group, start, end in stretches:
                beside[:] = rows[group]
                across[:] = beside.T
                # one product gives what goes back and, by a column of ones, the total
                beside[:, -1] = 1
                to_group = to_rows[group]
                for at in range(start, end, BLOCK):
                    stop = min(at + BLOCK, end)
                    chance = np.matmul(given[at:stop], across, out=scratch[: stop - at])
                    np.exp(chance, out=chance)
                    total = np.matmul(chance, beside, out=sums[at:stop])[:, -1:]
                    line[first[: stop - at] + target[at:stop]] -= total[:, 0]
                    to_group += chance.T @ (given[at:stop] / total)
            for at in range(0, len(sums), ROWS):
                back[at : at + ROWS] += sums[at : at + ROWS, :-1] / sums[at : at + ROWS, -1:]

        softmax(groups[None], to_groups[None], [(0, 0, len(own))], own // GROUP)
        in_groups = (self.groups, GROUP, -1)
        softmax(words.reshape(in_groups), to_words.reshape(in_groups), stretches, own % GROUP)
        for at in range(0, len(own), ROWS):
            some, part = own[at : at + ROWS], back[at : at + ROWS]
            part -= groups[some // GROUP, :-1]
            part -= words[some, :-1]
            part *= 1 - hidden[at : at + ROWS] ** 2
        to_inner[:-1] += seen.T @ back
        to_inner[-1] += back.sum(0)
        at = room("at", (sides.size,), np.dtype(np.intp))
        at[:] = sides.ravel()
        slopes = np.matmul(back, inner[:-1].T, out=room("to sides", seen.shape, kind)).reshape(-1, VECTOR)
        summed = room("summed", (self.words + 1, VECTOR), np.dtype(np.float64))
        for k in range(VECTOR):
            summed[:, k] = np.bincount(at, slopes[:, k], len(summed))
        to_vectors[: len(summed)] += summed
        return slope

    def train(self, sides: np.ndarray, own: np.ndarray, seed: int = 4) -> None:
        """Steps by the positions in shuffled order, each parameter's scaled by its slopes so far."""
        draw, squares, room = np.random.default_rng(seed), np.zeros_like(self.own), Room()
        # a step's fixed cost is that of the whole network: more positions, larger steps
        size = min(max(len(own) // STEPS, MINIBATCH), LARGE)
        batches = -(-len(own) // size)
        for _ in range(max(PASSES, -(-STEPS // batches))):
            order = draw.permutation(len(own))
            for at in range(0, len(order), size):
                chosen = order[at : at + size]
                slope = self.slopes(sides.take(chosen, axis=0), own[chosen], room)
                for row in range(0, len(slope), ROWS):
                    self._change(slice(row, row + ROWS), slope, squares)

    def _change(self, span: slice, slope: np.ndarray, squares: np.ndarray) -> None:
        """A step of some rows, which uses up their slopes; a parameter without a slope so far stays as it is."""
        own, part, sums = self.own[span], slope[span], squares[span]
        sums += part * part
        scale = sums + 1e-12
        np.sqrt(scale, out=scale)
        part *= STEP
        own -= np.divide(part, scale, out=part)
        biases = own[: max(0, self.layer - span.start), -1].copy()
        np.clip(own, -LARGEST, LARGEST, out=own)
        own[: len(biases), -1] = np.minimum(biases, LARGEST)


POSITIONS = "place array<int>"


def _share(vocabulary: Vocabulary) -> float:
    return min(1.0, max(1 / SHARE, LEAST / max(1, int(vocabulary.counts.sum()))))


def _places(batches, vocabulary: Vocabulary, share: float):
    """The ids on both sides and of the word itself, a row for each position of all texts, or for a share of them."""
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        draw = np.random.default_rng((part, number))
        for group in _in_stretches(_found(batch)):
            sides, own = vocabulary.contexts(group)
            places = np.column_stack([sides, own]).astype(np.int32, copy=False)
            yield places if share >= 1 else places[draw.random(len(own)) < share]


def positions(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``place``, what trainers of these texts learn from; they make it themselves and don't store it."""

    share = _share(vocabulary)

    def work(batches):
        for places in _places(batches, vocabulary, share):
            rows = pa.FixedSizeListArray.from_arrays(places.ravel(), places.shape[1])
            yield {"place": rows.cast(pa.list_(pa.int32()))}

    return by_batch(docs.select(_given(docs)), POSITIONS, work)


def trained(docs: DataFrame, vocabulary: Vocabulary) -> Network:
    """A network trained by as many tasks as there are positions for.

    What reaches the driver is one network, however many trainers there were.
    """
    start = Network(vocabulary.counts)
    total, share = int(vocabulary.counts.sum()), _share(vocabulary)
    expected = min(total, max(total // SHARE, LEAST))
    if not total:
        return start
    # buckets or texts travel, being smaller than their positions; each trainer makes its own
    given = docs.select(_given(docs)).repartition(-(-expected // TRAINER))

    def work(batches):
        places = list(_places(batches, vocabulary, share))
        if not places:
            return
        sides, own_ids = np.concatenate([p[:, :-1] for p in places]), np.concatenate([p[:, -1] for p in places])
        own = Network(vocabulary.counts)
        own.train(sides, own_ids)
        change = own.own - start.own
        # a vector is touched where its word stood beside another, weights in nearly every step
        touched = np.column_stack([change[:, :VECTOR].any(1), change[:, VECTOR:].any(1)])
        rows = np.flatnonzero(touched.any(1))
        yield {"row": rows, "change": [c.tobytes() for c in change[rows]], "seen": touched[rows] @ np.array([1, 2])}

    changes = by_batch(given, "row int, change binary, seen int", work)

    def added(batches):
        total, seen = np.zeros_like(start.own), np.zeros((len(start.own), 2))
        for batch in batches:
            rows = batch.column("row").to_numpy()
            change = np.frombuffer(b"".join(batch.column("change").to_pylist()), dtype=np.float32).reshape(-1, WIDTH)
            np.add.at(total, rows, change)
            parts = batch.column("seen").to_numpy()
            np.add.at(seen, rows, np.column_stack([parts & 1, parts >> 1]))
        rows = np.flatnonzero(seen.any(1))
        number = np.maximum(seen[rows], 1)
        mean = total[rows] / np.repeat(number, [VECTOR, WIDTH - VECTOR], axis=1)
        yield {"row": rows, "change": [c.tobytes() for c in mean.astype(np.float32)]}

    found = by_batch(changes.repartition("row"), "row int, change binary", added).toArrow()
    rows = found["row"].to_numpy()
    change = np.frombuffer(b"".join(found["change"].to_pylist()), dtype=np.float32).reshape(-1, WIDTH)
    start.own[rows] += change
    return start


@dataclass
class Model:
    """The words' places and the network that predicts them."""

    vocabulary: Vocabulary
    network: Network

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        """The summed conditional log-probabilities of texts given as buckets."""
        if not found:
            return np.empty(0)
        room, (sides, own) = Room(), self.vocabulary.contexts(found)
        each = [self.network.logs(sides[i : i + SCORED], own[i : i + SCORED], room) for i in range(0, len(own), SCORED)]
        sums = np.concatenate([[0.0], np.cumsum(np.concatenate([np.empty(0), *each]), dtype=np.float64)])
        ends = np.cumsum([len(b) for b in found])
        return sums[ends] - sums[np.concatenate([[0], ends[:-1]])]


def learn(docs: DataFrame) -> Model:
    """A model of ``docs``, which have ``text`` or what ``worded`` made of it; null texts count as empty.

    Words of a bucket that the corpus lacks are scored as if seen half a time. A corpus without
    a word gives the untrained network.
    """
    vocabulary = Vocabulary.of(word_counts(docs))
    return Model(vocabulary, trained(docs, vocabulary))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` and its mean ``per_token`` of whole texts.

    Needs ``doc_id`` and ``text``, or what ``worded`` made of it; others are not read. Null and empty texts have no token and
    score 0; repeated rows give repeated rows, a null id stays null, an empty table gives an
    empty result.
    """

    def work(batches):
        for batch in batches:
            found = _found(batch)
            sums = np.concatenate([model.score(g) for g in _in_stretches(found)]) if found else np.empty(0)
            number = np.array([len(b) for b in found], dtype=np.int64)
            yield {
                "doc_id": batch.column("doc_id"),
                "n_tokens": number,
                "log_likelihood": sums,
                "per_token": sums / np.maximum(number, 1),
            }

    own = docs.select(F.col("doc_id").cast("long"), _given(docs))
    return by_batch(own, "doc_id bigint, n_tokens bigint, log_likelihood double, per_token double", work)
