"""Byte-level BPE encoding and decoding, with tree concatenation for long unsplit text.

A text is split by the tokenizer's pattern, and merges never cross a split. A run that the
pattern leaves whole can be very long; it is cut in halves down to leaves, the leaves are
encoded on their own, and neighbours are put together pairwise, up the tree: tokens around
a join are encoded again as one text, in growing windows, until the tokens at both ends of
the window are the ones that stood there before. Two neighbouring tokens that occur side by
side in any right encoding can always stand side by side, so equal ends make the whole
sequence the right one.

Texts above ``LONG`` characters are dealt out: cut where a split is certain (a letter
followed by a space) or, where there is none, at leaves to be joined; the parts are
encoded by different tasks and the tree of a document is folded afterwards.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, texts

#: bytes of a leaf of an unsplit run
LEAF = 512
#: tokens on either side of a join that the first window encodes again
WINDOW = 8
#: characters above which a text is encoded by several tasks
LONG = 65_536
#: the pattern of the vocabulary's public description, a fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANKS = re.compile(r"\s{%d}" % LEAF)


def bytes_of_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


@dataclass
class Codec:
    """A byte-level vocabulary read from a tokenizers file."""

    split: tiktoken.Encoding
    whole: tiktoken.Encoding
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Codec:
        """Ranks are the file's merges in order, which its ids follow."""
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        letters = bytes_of_letters()
        special = {t["content"]: t["id"] for t in found["added_tokens"]}
        vocabulary = {t: i for t, i in found["model"]["vocab"].items() if t not in special}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        split = tiktoken.Encoding("split", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return cls(split, whole, special)

    def bytes_of(self, ids: list[int]) -> bytes:
        return self.split.decode_bytes(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return self.bytes_of(ids).decode("utf-8", errors="replace")

    def merged(self, run: str) -> list[int]:
        """Ids of a run the pattern leaves whole, by a tree over its halves."""
        if len(run) <= LEAF:
            return self.whole.encode_ordinary(run)
        middle = len(run) // 2
        return self.joined(self.merged(run[:middle]), self.merged(run[middle:]))

    def joined(self, left: list[int], right: list[int], encode: Callable | None = None) -> list[int]:
        """The ids of two neighbouring texts as one text; ``encode`` is that of a single run."""
        encode = encode or self.whole.encode_ordinary
        if not left or not right:
            return left or right
        window = WINDOW
        while True:
            a, b = max(0, len(left) - window), min(len(right), window)
            while a and self.bytes_of(left[a : a + 1])[0] & 0xC0 == 0x80:
                a -= 1  # a window begins and ends between characters
            while b < len(right) and self.bytes_of(right[b : b + 1])[0] & 0xC0 == 0x80:
                b += 1
            seen = self.bytes_of([*left[a:], *right[:b]]).decode("utf-8")
            again = list(encode(seen))
            first = a == 0 or again[:2] == left[a : a + 2]
            last = b == len(right) or again[-2:] == right[max(0, b - 2) : b]
            if first and last:
                return [*left[:a], *again, *right[b:]]
            window *= 2

    def _ordinary(self, text: str) -> list[int]:
        if not _unsplit(text):
            return self.split.encode_ordinary(text)
        ids: list[int] = []
        for run in _runs(text):
            ids += self.merged(run) if len(run) > LEAF else self.split.encode_ordinary(run)
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text; the names of special tokens in it are those tokens."""
        if not any(name in text for name in self.special):
            return np.array(self._ordinary(text), dtype="<u4")
        ids: list[int] = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
            ids += [self.special[part]] if part in self.special else self._ordinary(part)
        return np.array(ids, dtype="<u4")


def _unsplit(text: str) -> bool:
    """Whether a run of the text may be longer than a leaf."""
    return max(map(len, text.split()), default=0) > LEAF or _BLANKS.search(text) is not None


def _runs(text: str) -> list[str]:
    """The text as the pattern splits it."""
    import regex

    return regex.findall(PATTERN, text)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a file, made once per process."""
    if path not in _CODECS:
        _CODECS[path] = Codec.load(path)
    return _CODECS[path]


def cuts(text: str, size: int, special: list[str]) -> list[tuple[int, bool]]:
    """Where to cut a long text, and whether a split is certain there.

    Certain is a letter before a space: the pattern ends every match there, and no special
    token holds a space. Elsewhere the parts have to be joined; a special token stays whole.
    """
    found, at = [], size
    while at < len(text):
        space = next((m.start() + 1 for m in _SAFE.finditer(text, at, at + size)), None)
        if space is None:
            for name in special:
                start = text.find(name, max(0, at - len(name) + 1), at + len(name) - 1)
                at = start + len(name) if start >= 0 else at
            if at >= len(text):
                break
        found.append((space or at, space is not None))
        at = found[-1][0] + size
    return found


_SAFE = re.compile(r"[a-zA-Z](?= )")


def _short(path: str):
    def work(batches):
        encode = codec(path).encode
        for batch in batches:
            found = [encode(t) for t in texts(batch)]
            yield {
                "doc_id": batch.column("doc_id"),
                "n_tokens": [len(ids) for ids in found],
                "ids": [ids.tobytes() for ids in found],
            }

    return work


def _parts(path: str, size: int):
    def work(batches):
        special = list(codec(path).special)
        for batch in batches:
            rows = {name: [] for name in ("row", "doc_id", "part", "certain", "text")}
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                marks = [(0, True), *cuts(text, size, special), (len(text), True)]
                for part, ((start, certain), (end, _)) in enumerate(zip(marks, marks[1:])):
                    for name, value in zip(rows, (row, doc_id, part, certain, text[start:end])):
                        rows[name].append(value)
            yield rows

    return work


def _leaves(path: str):
    def work(batches):
        encode = codec(path).encode
        for batch in batches:
            found = [encode(t).tobytes() for t in texts(batch)]
            yield {c: batch.column(c) for c in ("row", "doc_id", "part", "certain")} | {"ids": found}

    return work


def _folded(path: str):
    def work(parts: pd.DataFrame) -> pd.DataFrame:
        """The ids of one document: neighbours joined pairwise until one is left."""
        own = codec(path)
        parts = parts.sort_values("part")
        level = [(np.frombuffer(i, dtype="<u4").tolist(), c) for i, c in zip(parts["ids"], parts["certain"])]
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = [
                p[0] if len(p) == 1 else (p[0][0] + p[1][0] if p[1][1] else own.joined(p[0][0], p[1][0], own.encode), p[0][1])
                for p in pairs
            ]
        ids = np.array(level[0][0], dtype="<u4")
        return pd.DataFrame({"doc_id": parts["doc_id"].iloc[:1], "n_tokens": [len(ids)], "ids": [ids.tobytes()]})

    return work


ENCODED = "doc_id bigint, n_tokens bigint, ids binary"


def encode(docs: DataFrame, path: str, long: int = LONG) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of whole texts.

    ``path`` is a byte-level BPE file of the tokenizers library; the ids are those of its
    ``encode`` without special tokens added, truncation or padding. Needs columns ``doc_id``
    and ``text``; others are not read. A null or empty text has no ids; repeated rows give
    repeated rows, a null id stays null, an empty table gives an empty result. Texts of more
    than ``long`` characters are encoded in parts by several tasks.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    is_long = F.coalesce(F.length("text") > long, F.lit(False))
    short = by_batch(own.where(~is_long).select("doc_id", "text"), ENCODED, _short(path))
    parts = by_batch(
        own.where(is_long), "row bigint, doc_id bigint, part int, certain boolean, text string", _parts(path, long // 4)
    )
    leaves = by_batch(
        parts.repartition("row", "part"),
        "row bigint, doc_id bigint, part int, certain boolean, ids binary",
        _leaves(path),
    )
    return short.unionByName(leaves.groupBy("row").applyInPandas(_folded(path), ENCODED))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the text of their ids, special tokens included."""

    def work(batches):
        own = codec(path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            found = [own.decode(np.frombuffer(i or b"", dtype="<u4").tolist()) for i in ids]
            yield {c: batch.column(c) for c in ("doc_id", "n_tokens", "ids")} | {"decoded": found}

    return by_batch(encoded.select("doc_id", "n_tokens", "ids"), ENCODED + ", decoded string", work)
