import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_cases import ROWS, documents, empty

from newstide.llm import queries, segment_bpe

SPLIT = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = ["a", "th", "e", "é", " ", "  ", "\n", "1", "23", "!", "'", "'s", "ñ", "日本", "😀", "<|endoftext|>", "==", "\t", "　", "\x1c", "ﬁ", "İ", "́"]


@pytest.fixture(scope="module")
def library():
    ranks = segment_bpe.vocabulary(*SPLIT).ranks
    return tiktoken.Encoding("own", pat_str=SPLIT[1], mergeable_ranks=ranks, special_tokens={})


def merged_plainly(piece, ranks):
    """Look at all pairs before every merge."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return tuple(ranks[p] for p in parts)
        at = min(pairs)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@pytest.mark.parametrize("packed", [segment_bpe.PACKED, 3])
@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"the in", b"\x00\xff\xc3\xa9", b"0129"])
def test_merges_by_the_tree(monkeypatch, alphabet, packed):
    monkeypatch.setattr(segment_bpe, "PACKED", packed)
    ranks, draw = segment_bpe.vocabulary(*SPLIT).ranks, random.Random(len(alphabet))
    for length in [*range(1, 40), 63, 64, 65, 300]:
        piece = bytes(draw.choice(alphabet) for _ in range(length))
        assert segment_bpe.merged(piece, ranks) == merged_plainly(piece, ranks)


def test_equal_ranks_are_merged_from_the_left():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"ba": 257, b"aba": 258, b"aa": 259, b"aaa": 260}
    assert segment_bpe.merged(b"ababa", ranks) == (256, 258)
    assert segment_bpe.merged(b"aaaaaa", ranks) == merged_plainly(b"aaaaaa", ranks)


def test_every_character_is_split_as_the_library_does(library):
    own = segment_bpe.vocabulary(*SPLIT)
    for c in [*range(0xD800), *range(0xE000, 0x30000, 7)]:
        text = f"a{chr(c)}{chr(c)}a 1{chr(c)} {chr(c)}!"
        assert own.encode(text).tolist() == library.encode_ordinary(text), hex(c)


@pytest.mark.parametrize("split,remembered", [(segment_bpe.SPLIT, segment_bpe.REMEMBERED), (5, 3)])
def test_tables(spark, library, monkeypatch, split, remembered):
    monkeypatch.setattr(segment_bpe, "SPLIT", split)
    monkeypatch.setattr(segment_bpe, "REMEMBERED", remembered)
    draw = random.Random(6)
    rows = [*ROWS, (8, "ab" * 9000), (9, "x y " * 50 + "z" * 900 + "<|endoftext|>" * 5), (10, "x" * 40_000)]
    rows += [(20 + i, "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 300)))) for i in range(30)]
    own = segment_bpe.Vocabulary(*SPLIT)
    assert [own.encode(t or "").tolist() for _, t in rows] == [library.encode_ordinary(t or "") for _, t in rows]
    found = segment_bpe.decode(segment_bpe.encode(documents(spark, rows), *SPLIT), *SPLIT).collect()
    want = [(i or 0, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in found) == sorted(want)
    assert all(r.n_tokens == len(r.ids) for r in found)
    assert segment_bpe.encode(empty(spark), *SPLIT).collect() == []


def test_null_ids_are_decoded_to_nothing(spark):
    encoded = spark.createDataFrame([(1, 0, None), (2, 1, [50])], segment_bpe.ENCODED)
    assert [bytes(r.decoded) for r in segment_bpe.decode(encoded, *SPLIT).orderBy("doc_id").collect()] == [b"", b"S"]


def test_query(spark, sf_dir, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        want[doc_id] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids)))
    rows = queries.op11_segment_bpe(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want and len(rows) == len(docs)


def test_pieces_merged_together_equal_pieces_merged_one_by_one():
    own = segment_bpe.Vocabulary(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    draw = random.Random(11)
    letters = ["abcdefghijklmnopqrstuvwxyz", "aab", "éßñ日本😀", "etaoin shrdlu", "0123456789-_"]
    for longest in (2, 3, 4, 5, 8, 9, 17, 64):
        pieces = ["".join(draw.choice(draw.choice(letters)) for _ in range(draw.randint(1, longest))).encode()[:longest] for _ in range(300)]
        ids = segment_bpe.merged_together(pieces, own.pairs)
        assert [tuple(np.frombuffer(i, dtype=np.int32)) for i in ids] == [segment_bpe.merged(p, own.ranks) for p in pieces]


def test_texts_together_equal_texts_alone(monkeypatch):
    draw = random.Random(12)
    given = [" ".join("".join(draw.choices("aeionrstlé", k=draw.randint(1, 70))) for _ in range(draw.randint(0, 80))) for _ in range(60)]
    alone = [list(segment_bpe.Vocabulary(queries.BYTE_RANKS, public_tokenizers.PATTERN).encode(t)) for t in given[:3]]
    for remembered, together in ((250_000, 1 << 20), (100, 3000), (5, 1)):
        monkeypatch.setattr(segment_bpe, "REMEMBERED", remembered)
        monkeypatch.setattr(segment_bpe, "TOGETHER", together)
        own = segment_bpe.Vocabulary(queries.BYTE_RANKS, public_tokenizers.PATTERN)
        found = [list(i) for i in own.encode_all(given)]
        assert found[:3] == alone and found == [[r for p in own.pattern.findall(t) for r in own.merged(p.encode())] for t in given]


def test_pieces_are_looked_up_once_and_decoded_in_columns():
    """A piece that is remembered is asked for once; lists of ids become bytes without Python numbers."""
    own, asked = segment_bpe.Vocabulary(*SPLIT), []
    text = "one two three one two three zyxq"
    want = own.encode(text).tolist()
    own.get = lambda piece: asked.append(piece) or dict.get(own, piece)
    assert own.encode_all([text, text])[1].tolist() == want and len(asked) == 2 * len(own.pattern.findall(text))
    ids = pa.array([want, None, [], want], pa.list_(pa.int32()))
    assert own.decode(ids.slice(1)).to_pylist() == [b"", b"", text.encode()]
    with pytest.raises((KeyError, pa.ArrowInvalid, IndexError)):
        own.decode(pa.array([[own.pairs.beyond]], pa.list_(pa.int32())))
