"""Text quality by a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector: its words hashed to ``BUCKETS`` features, a few statistics of
its structure, and its length as metadata. Every pair of features interacts with a weight of
low rank; the sum over all pairs is had in linear time from the identity
2 * sum_{i<j} <v_i, v_j> x_i x_j = sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.

The machine is trained in numpy on a bounded sample of labelled texts (``LABELLED`` per
label, chosen by hash), weighted back to the labels' shares of all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, crc_hash, filtered, texts

BUCKETS = 1 << 14
RANK = 8
#: about how many labelled texts of each label are learned from
LABELLED = 3000
EPOCHS = 6
MINIBATCH = 64
STEP = 0.1
#: words whose buckets a worker remembers
CACHE = 250_000

STATISTICS = (
    "log_chars log_words word_length longest_word upper lower digit blank line_end bar stop exclamation "
    "symbol beyond_ascii distinct_words top_word repeated_lines"
).split()
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t",
    "line_end": b"\n\r",
    "bar": b"|",
    "stop": b".,;:?'\"()-",
    "exclamation": b"!",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
}


def _class_matrix() -> np.ndarray:
    """Which bytes count for which statistic; bytes from 128 on are beyond ASCII."""
    matrix = np.zeros((256, len(_CLASSES) + 1))
    for place, members in enumerate(_CLASSES.values()):
        matrix[list(members), place] = 1
    matrix[128:, -1] = 1
    return matrix


_MATRIX = _class_matrix()


class _Buckets(dict):
    """The bucket of a word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = bucket = crc_hash(word) % BUCKETS
        return bucket


_BUCKETS = _Buckets()


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, their values (unit length) and the statistics of a text."""
    words = text.lower().split()
    ids = np.fromiter(map(_BUCKETS.__getitem__, words), dtype=np.int64, count=len(words))
    buckets, counts = np.unique(ids, return_counts=True)
    values = np.sqrt(counts)
    values /= np.sqrt((values**2).sum()) or 1.0
    coded = text.encode("utf-8", "surrogatepass")
    shares = np.bincount(np.frombuffer(coded, dtype=np.uint8), minlength=256) @ _MATRIX / max(1, len(coded))
    lines = text.split("\n")
    number = max(1, len(words))
    statistics = np.array(
        [
            np.log1p(len(text)),
            np.log1p(len(words)),
            len(text) / number,
            np.log1p(max(map(len, words), default=0)),
            *shares,
            len(set(words)) / number,
            counts.max(initial=0) / number,
            1 - len(set(lines)) / len(lines),
        ]
    )
    return buckets, values, statistics


@dataclass
class Machine:
    """Bias, linear weights and rank-``RANK`` factors; the statistics' mean and spread."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def rows(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature ids, values and row starts of texts, statistics scaled and appended."""
        own = BUCKETS + np.arange(len(STATISTICS))
        ids, values, starts, at = [], [], [], 0
        for buckets, weights, statistics in found:
            scaled = np.clip((statistics - self.mean) / self.spread, -4, 4) / np.sqrt(len(STATISTICS))
            ids += [buckets, own]
            values += [weights, scaled]
            starts.append(at)
            at += len(buckets) + len(own)
        return np.concatenate(ids), np.concatenate(values), np.array(starts)

    def margins(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each row, and its sums per factor; linear in the number of features."""
        weighted = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(weighted, starts)
        pairs = (sums**2 - np.add.reduceat(weighted**2, starts)).sum(1) / 2
        return self.bias + np.add.reduceat(self.linear[ids] * values, starts) + pairs, sums

    def scores(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        if not found:
            return np.empty(0)
        margins, _ = self.margins(*self.rows(found))
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def train(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray) -> Machine:
    """Logistic loss by adaptive gradient steps; the same sample gives the same machine.

    Without both labels in the sample, the machine is the prior: 1 where only label 1 (or
    none) was seen, 0 where only label 0.
    """
    size, draw = BUCKETS + len(STATISTICS), np.random.default_rng(7)
    statistics = np.array([s for _, _, s in found]).reshape(-1, len(STATISTICS))
    machine = Machine(
        0.0,
        np.zeros(size),
        draw.normal(0, 0.05, (size, RANK)),
        statistics.mean(0) if len(found) else np.zeros(len(STATISTICS)),
        np.maximum(statistics.std(0), 1e-3) if len(found) else np.ones(len(STATISTICS)),
    )
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        machine.bias = -30.0 if len(labels) and labels[0] == 0 else 30.0
        return machine
    seen, seen_factors, seen_bias = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = draw.permutation(len(found))
        for at in range(0, len(order), MINIBATCH):
            chosen = order[at : at + MINIBATCH]
            ids, values, starts = machine.rows([found[i] for i in chosen])
            margins, sums = machine.margins(ids, values, starts)
            error = weights[chosen] * (1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels[chosen])
            row = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(ids))))
            used, place = np.unique(ids, return_inverse=True)
            slope = np.zeros(len(used))
            np.add.at(slope, place, error[row] * values)
            each = (error[row] * values)[:, None] * (sums[row] - machine.factors[ids] * values[:, None])
            slope_factors = np.zeros((len(used), RANK))
            np.add.at(slope_factors, place, each)
            slope_factors += 1e-4 * machine.factors[used]
            seen[used] += slope**2
            seen_factors[used] += slope_factors**2
            seen_bias += error.sum() ** 2
            machine.linear[used] -= STEP * slope / np.sqrt(seen[used])
            machine.factors[used] -= STEP / 2 * slope_factors / np.sqrt(seen_factors[used])
            machine.bias -= STEP * error.sum() / np.sqrt(seen_bias)
    return machine


def _sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """About ``LABELLED`` texts of each label, and how many labelled rows each label has."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.select("doc_id", "quality").distinct()
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    scale = 1 << 30
    limit = F.lit(0)
    for label, number in sizes.items():
        limit = F.when(F.col("quality") == label, F.lit(min(scale, scale * LABELLED // number))).otherwise(limit)
    # the sample's size has a bound that no input moves, so it may be broadcast
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < limit)
    joined = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    return joined.withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash", "quality"]), sizes


def learn(docs: DataFrame, labels: DataFrame, learned: Column | None = None) -> Machine:
    """A machine from ``labels`` (``doc_id``, ``quality`` 0 or 1) of the documents' texts.

    ``learned`` selects label rows by their columns. Null ids, labels other than 0 and 1 and
    null texts are not learned from. What reaches the driver is the bounded sample's features.
    """
    sample, sizes = _sampled(docs, labels if learned is None else labels.where(F.coalesce(learned, F.lit(False))))

    def work(batches):
        for batch in batches:
            found = [features(t) for t in texts(batch)]
            columns = {c: batch.column(c) for c in ("hash", "quality")}
            columns["buckets"] = [buckets.astype(np.int32) for buckets, _, _ in found]
            columns["weights"] = [weights.astype(np.float32) for _, weights, _ in found]
            columns["statistics"] = [statistics for _, _, statistics in found]
            yield columns

    ddl = "hash bigint, quality int, buckets array<int>, weights array<float>, statistics array<double>"
    wanted = sample.select("hash", F.col("quality").cast("int"), "text")
    rows = by_batch(wanted, ddl, work).toArrow().sort_by([("hash", "ascending"), ("quality", "ascending")]).combine_chunks()
    labels_seen = rows["quality"].to_numpy().astype(float)
    share = {label: number / sum(sizes.values()) for label, number in sizes.items()}
    weights = np.array([share[int(y)] / (labels_seen == y).mean() for y in labels_seen])
    columns = [rows[c].combine_chunks() for c in ("buckets", "weights", "statistics")]
    return train([tuple(c[i].values.to_numpy() for c in columns) for i in range(len(rows))], labels_seen, weights)


def _scored(machine: Machine, own: list[str]) -> np.ndarray:
    """Scores of texts, some hundred at a time."""
    found = [machine.scores([features(t) for t in own[i : i + 256]]) for i in range(0, len(own), 256)]
    return np.concatenate(found) if found else np.empty(0)


def score(docs: DataFrame, machine: Machine, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``score``, the probability of label 1, of every row.

    Only the text decides; a null text counts as empty and is scored too. Repeated rows give
    repeated rows with equal scores, an empty table an empty result.
    """

    def work(batches):
        for batch in batches:
            yield {k: batch.column(k) for k in keep} | {"score": _scored(machine, texts(batch))}

    kept = docs.select(*keep)
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return by_batch(docs.select(*dict.fromkeys([*keep, "text"])), ddl + "score double", work)


def accepted(docs: DataFrame, machine: Machine, least: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose text scores ``least`` or more; null counts as empty."""
    return filtered(docs, lambda own: _scored(machine, own) >= least)
