"""Byte-level BPE encoding and decoding, with a segment tree over the bytes of a piece.

A text is split by the vocabulary's pattern, and each piece is merged on its own. A live token
starts at a byte position; the position's leaf holds the rank of the token and its right
neighbour put together, and every inner node the least of its children, the leftmost among
equals. The root thus names the next merge. A merge changes three leaves: that of the token
that grew, that of the neighbour it swallowed and that of the token before it; each is a
point update up the tree, so a piece of n bytes takes O(n log n) steps however long it is.

Short pieces are merged together, a merge of each at a time: their trees are the rows of one array.
"""

from __future__ import annotations

import base64
from array import array
from itertools import accumulate, chain, filterfalse, islice, pairwise
from sys import byteorder

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import by_batch, texts

#: a leaf without a pair, above all ranks
NO_PAIR = 1 << 62
#: bytes above which a piece's tree is kept in packed arrays, four times smaller and a little slower
PACKED = 1 << 12
#: pieces of at most so many bytes are remembered, so many in either half of the memory
SHORT, REMEMBERED = 48, 250_000
#: pieces of a text that are split at once, and characters of texts whose pieces are learnt together
SPLIT, TOGETHER = 1 << 16, 1 << 20
#: bytes of a piece up to which pieces are merged together, so many at once, and how few are merged one by one
SMALL, ROWS, FEW = 64, 4096, 64


def merged(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of a piece of bytes, merged by a segment tree over its positions.

    A leaf is the rank of the pair that begins at its position, followed by the position in the
    lower bits: the least of such numbers is the least rank, of equal ones the leftmost.
    """
    n = len(piece)
    bits = max(n - 2, 0).bit_length()
    size, here, rank_of = 1 << bits, (1 << bits) - 1, ranks.get
    # where the token that starts at a position ends, and where the token that ends there starts
    end, start = list(range(1, n + 2)), list(range(-1, n + 1))
    level = [NO_PAIR if (r := rank_of(piece[i : i + 2])) is None else r << bits | i for i in range(n - 1)]
    level += [NO_PAIR] * (size - len(level))
    nodes = level
    while len(level) > 1:
        level = list(map(min, level[::2], level[1::2]))
        nodes = level + nodes
    nodes = [NO_PAIR, *nodes]
    if n > PACKED:
        end, start, nodes = array("q", end), array("q", start), array("q", nodes)
    while (top := nodes[1]) != NO_PAIR:
        at = top & here
        swallowed = end[at]
        stop = end[at] = end[swallowed]
        start[stop] = at
        if stop < n:
            grown = rank_of(piece[at : end[stop]])
            points = ((swallowed, NO_PAIR), (at, NO_PAIR if grown is None else grown << bits | at))
        else:  # the last token is in no pair
            points = ((at, NO_PAIR),)
        if at:
            before = start[at]
            grown = rank_of(piece[before:stop])
            points += ((before, NO_PAIR if grown is None else grown << bits | before),)
        for node, least in points:
            node += size
            nodes[node] = least
            while node > 1:
                other = nodes[node ^ 1]
                if other < least:
                    least = other
                node >>= 1
                if nodes[node] == least:
                    break
                nodes[node] = least
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return tuple(ids)


class Pairs:
    """The rank that two tokens, by id, make together: sorted keys of all pairs that make one."""

    def __init__(self, ranks: dict[bytes, int]):
        #: an id that no token has, for the end of a piece
        self.beyond = max(ranks.values(), default=0) + 1
        made = [
            (ranks[token[:k]] * (self.beyond + 1) + ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        made.append((1 << 62, 0))
        self.keys, self.ranks = np.array(sorted(made), dtype=np.int64).T.copy()
        self.bytes = np.array([ranks.get(bytes([b]), self.beyond) for b in range(256)], dtype=np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """The leaves of pairs of tokens that begin at these positions."""
        keys = left * (self.beyond + 1) + right
        found = np.searchsorted(self.keys, keys)
        return np.where(self.keys[found] == keys, self.ranks[found] << bits | at, NO_PAIR)


def merged_together(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """The ids of pieces, in 32 bits each, of pieces that need trees of about the same size.

    As ``merged``; every round makes the next merge of each piece that has one left.
    """
    lengths = np.array([len(p) for p in pieces])
    bits = int(lengths.max() - 1).bit_length()
    size, width = 1 << bits, (1 << bits) + 1
    places = np.arange(width)
    padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, width)
    live = places < lengths[:, None]
    tokens = np.where(live, pairs.bytes[padded], pairs.beyond)
    end, start = np.tile(places + 1, len(pieces)), np.tile(places - 1, len(pieces))
    nodes = np.full((len(pieces), 2 * size), NO_PAIR, dtype=np.int64)
    nodes[:, size:] = pairs.leaves(tokens[:, :-1], tokens[:, 1:], places[:-1], bits)
    low = size
    while low > 1:
        low >>= 1
        np.minimum(nodes[:, 2 * low : 4 * low : 2], nodes[:, 2 * low + 1 : 4 * low : 2], out=nodes[:, low : 2 * low])
    nodes, tokens, live = nodes.ravel(), tokens.ravel(), live.ravel()

    def point(trees: np.ndarray, at: np.ndarray, least: np.ndarray | int) -> None:
        node = at + size
        nodes[trees + node] = least
        for _ in range(bits):
            least = np.minimum(nodes[trees + node], nodes[trees + (node ^ 1)])
            node = node >> 1
            nodes[trees + node] = least

    rows = np.arange(len(pieces))
    while True:
        top = nodes[rows * (2 * size) + 1]
        left = top != NO_PAIR
        if not left.all():
            rows, top = rows[left], top[left]
        if not len(rows):
            break
        trees, first = rows * (2 * size), rows * width
        at, rank = top & (size - 1), top >> bits
        swallowed = end[first + at]
        stop = end[first + swallowed]
        end[first + at], start[first + stop], tokens[first + at], live[first + swallowed] = stop, at, rank, False
        point(trees, swallowed, NO_PAIR)
        point(trees, at, pairs.leaves(rank, tokens[first + stop], at, bits))
        inner = at > 0
        trees, first, at, rank = trees[inner], first[inner], at[inner], rank[inner]
        before = start[first + at]
        point(trees, before, pairs.leaves(tokens[first + before], rank, before, bits))
    ids = tokens[live].astype(np.int32).tobytes()
    counts = live.reshape(-1, width).sum(axis=1).tolist()
    return [ids[4 * a : 4 * b] for a, b in pairwise(accumulate(counts, initial=0))]


class Vocabulary(dict):
    """Ranks of a tiktoken file; as a mapping, the ids of pieces in 32 bits each, those of short ones remembered."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.by_id = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self._older: dict[str, bytes] = {}
        self.pairs = Pairs(self.ranks)
        #: whether every byte is a token
        self.whole = bool((self.pairs.bytes < self.pairs.beyond).all())
        #: tokens by id, null where no token has it
        self.tokens = pa.array(map(self.by_id.get, range(self.pairs.beyond)), pa.binary())

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The ids of a piece; one that is a token as it stands is that token."""
        whole = self.ranks.get(piece)
        return merged(piece, self.ranks) if whole is None else (whole,)

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece) or array("i", self.merged(piece.encode())).tobytes()
        if len(piece) <= SHORT:
            self.remember(piece, ids)
        return ids

    def remember(self, piece: str, ids: bytes) -> None:
        if len(self) >= REMEMBERED:
            self._older = dict(self)
            self.clear()
        self[piece] = ids

    def learn(self, pieces: set[str]) -> None:
        """Remembers short pieces that are new, merged together; others are merged when they are asked for."""
        by_size: dict[int, list[str]] = {}
        # bytes that are no tokens, in a vocabulary of a user's own, are left to ``merged``
        for piece in filterfalse(self._older.__contains__, pieces) if self.whole else ():
            if len(piece) <= SHORT:
                own = piece.encode()
                if (rank := self.ranks.get(own)) is not None:
                    self.remember(piece, rank.to_bytes(4, byteorder))
                elif len(own) <= SMALL:
                    by_size.setdefault((len(own) - 1).bit_length(), []).append(piece)
        for new in by_size.values():
            for i in range(0, len(new) if len(new) >= FEW else 0, ROWS):
                some = new[i : i + ROWS]
                for piece, ids in zip(some, merged_together([p.encode() for p in some], self.pairs)):
                    self.remember(piece, ids)

    def looked_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces; those not remembered are learnt first, together."""
        found = list(map(self.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        self.learn({pieces[i] for i in new})
        for i in new:
            found[i] = self[pieces[i]]
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, split a stretch at a time."""
        pieces, stretches = (m.group() for m in self.pattern.finditer(text)), []
        while stretch := list(islice(pieces, SPLIT)):
            stretches.append(b"".join(self.looked_up(stretch)))
        return np.frombuffer(b"".join(stretches), dtype=np.int32)

    def encode_all(self, given: list[str]) -> list[np.ndarray]:
        """The ids of texts; the pieces of texts that are short together are learnt at once."""
        found, waiting, length = [], [], 0
        for text in [*given, None]:
            if waiting and (text is None or length + len(text) > TOGETHER):
                split = [self.pattern.findall(t) for t in waiting]
                ids = iter(self.looked_up(list(chain.from_iterable(split))))
                found += [np.frombuffer(b"".join(islice(ids, len(s))), dtype=np.int32) for s in split]
                waiting, length = [], 0
            if text is not None and len(text) > TOGETHER:
                found.append(self.encode(text))
            elif text is not None:
                waiting.append(text)
                length += len(text)
        return found

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of lists of ids; a null list has none."""
        tokens = self.tokens.take(ids.flatten())
        if tokens.null_count:
            raise KeyError("an id that no token has")
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False), dtype=np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(np.concatenate([np.zeros(1, np.int32), ends]), tokens), b"")


_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The worker's vocabulary of a file, read once per process."""
    if (path, pattern) not in _VOCABULARIES:
        _VOCABULARIES[path, pattern] = Vocabulary(path, pattern)
    return _VOCABULARIES[path, pattern]


ENCODED = "doc_id bigint, n_tokens bigint, ids array<int>"


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of whole texts.

    ``path`` is a file of ranks as the tiktoken library reads it, present on every executor, and
    ``pattern`` splits a text before the merges. Names of special tokens are ordinary text. Needs
    columns ``doc_id`` and ``text``; others are not read. A null or empty text has no ids;
    repeated rows give repeated rows, a null id stays null, an empty table gives an empty
    result. Equal ranks at several places are merged from the left. A piece takes some
    50 bytes of memory a byte while it is merged; texts are split a stretch at a time.
    """

    def work(batches):
        own = vocabulary(path, pattern)
        for batch in batches:
            found = own.encode_all(texts(batch))
            yield {"doc_id": batch.column("doc_id"), "n_tokens": [len(i) for i in found], "ids": found}

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), ENCODED, work)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes of their ids; null ids have none."""

    def work(batches):
        own = vocabulary(path, pattern)
        for batch in batches:
            found = {c: batch.column(c) for c in ("doc_id", "n_tokens", "ids")}
            yield found | {"decoded": own.decode(found["ids"])}

    return by_batch(encoded.select("doc_id", "n_tokens", "ids"), ENCODED + ", decoded binary", work)
