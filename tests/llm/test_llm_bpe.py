import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ROWS, documents, empty
from tokenizers import Tokenizer

from newstide.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "th", "e", "é", " ", "  ", "\n", "1", "23", "!", "'", "'s", "ñ", "日本", "😀", "<|endoftext|>", "-", "==", "aaaa", "\t", "　", "\x1c", "ﬁ", "İ", "́"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_the_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_short_texts(library):
    codec, draw = bpe.codec(PATH), random.Random(1)
    for _ in range(2000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 60)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
        some = ids[draw.randrange(len(ids) + 1) :][: draw.randint(0, 9)]  # may begin or end inside a character
        assert codec.decode(some) == codec.bytes_of(some).decode("utf-8", "replace")


@pytest.mark.parametrize("alphabet", [["a"], ["a", "b"], ["th", "in", "er", "e"], ["é", "ñ"], ["日", "本", "語"], ["-", "="], ["1", "2", "9"], ["a", "aa", "t"], [" "], ["\n", " "], ["x" * 30, "y"], ["!", ".", "😀"]])
def test_unsplit_runs_by_the_tree(library, alphabet):
    codec, draw = bpe.codec(PATH), random.Random(len(alphabet[0]))
    for _ in range(6):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(400, 5000))) + draw.choice(["", " end", "."])
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_joining_widens_its_window_until_both_sides_agree(library):
    codec, draw = bpe.codec(PATH), random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice("abcdefg tt'se!1é") for _ in range(draw.randint(2, 200)))
        at = draw.randrange(1, len(text))
        halves = codec.encode(text[:at]).tolist(), codec.encode(text[at:]).tolist()
        assert codec.joined(*halves, codec.encode) == library.encode(text, add_special_tokens=False).ids


def test_cuts_keep_special_tokens_whole():
    text = "x" * 95 + "<|endoftext|>" + "y" * 300 + " a b" * 40
    marks = bpe.cuts(text, 100, ["<|endoftext|>"])
    assert marks[0] == (108, False) and all(text[a - 1].isalpha() and text[a] == " " for a, safe in marks if safe)


@pytest.mark.parametrize("long", [bpe.LONG, 40])
def test_tables(spark, library, long):
    draw = random.Random(6)
    rows = [*ROWS, (8, "ab" * 900), (9, "x y " * 50 + "z" * 900 + "<|endoftext|>" * 5)]
    rows += [(20 + i, "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 300)))) for i in range(30)]
    found = bpe.decode(bpe.encode(documents(spark, rows), PATH, long), PATH).collect()
    want = [(i or 0, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows]
    got = [(r.doc_id or 0, np.frombuffer(r.ids, dtype="<u4").tolist(), r.decoded) for r in found]
    assert sorted(got) == sorted(want) and all(r.n_tokens * 4 == len(r.ids) for r in found)
    assert bpe.encode(empty(spark), PATH, long).collect() == []


def test_query(spark, sf_dir, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(decoded.encode()))
    rows = queries.op6_bpe(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want and len(rows) == len(docs)
