import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ROWS, documents, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newstide.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def laid_out(places):
    """Sequences as sorted lists of (offset, length), which must follow each other."""
    found = {}
    for sequence, offset, length in places:
        found.setdefault(sequence, []).append((offset, length))
    for own in found.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
    return found


def test_words_are_encoded_as_the_library_does(library):
    encode, draw = packing.encoder(PATH).encode, random.Random(2)
    pieces = ["a", "Th", "e", "É", "é", " ", "  ", "\n", "1", "23", "!", "'", "'s", "'S", "ñ", "ß", "日本", "😀", "<|endoftext|>", "-", "aaaa", "\t", "\x1c", "\x00", "İ", "́", "_", "“", "…", "€", "’", "\x0b", "º", "'LL", "ing", "tion"]
    for n in range(2000):
        text = "".join(draw.choice(pieces if n % 3 else pieces[:16]) for _ in range(draw.randint(0, 50)))
        assert encode(text) == library(text), text
    assert encode("x" * 5000 + " y") == library("x" * 5000 + " y")


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_all_and_is_no_worse_than_best_fit_item_by_item(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 30, 64, 2048])
    counts = {draw.randint(1, capacity): draw.randint(1, 40) for _ in range(draw.randint(0, 60))}
    places, ranks = [], {}
    for step in packing.plan(counts, capacity):
        assert step.rank == ranks.get(step.length, 0)
        ranks[step.length] = step.rank + step.bins * step.each
        for i in range(step.bins * step.each):
            places.append((step.first_bin + i // step.each, step.offset + i % step.each * step.length, step.length))
    assert ranks == counts
    bins = laid_out(places)
    assert all(sum(n for _, n in own) <= capacity and sum(3 * n > capacity for _, n in own) <= 2 for own in bins.values())
    gaps = []
    for size in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fitting = [g for g in gaps if g >= size]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - size)
    assert len(bins) <= len(gaps) * 1.08 + 1


def test_pieces_and_sequences(spark, library):
    packed = packing.pack(documents(spark).repartition(3), PATH, capacity=64).collect()
    assert len(laid_out((r.sequence_id, r.offset, r.length) for r in packed)) == max(r.sequence_id for r in packed) + 1
    texts = sorted((i or 0, library(t or "") + bytes(4)) for i, t in ROWS)
    whole = {}
    for r in sorted(packed, key=lambda r: r.start):
        assert r.length == len(r.ids) // 4 <= 64 and r.start == r.piece * 64
    want = sorted((i, p, ids[at : at + 256]) for i, ids in texts for p, at in enumerate(range(0, len(ids), 256)))
    assert sorted((r.doc_id or 0, r.piece, bytes(r.ids)) for r in packed) == want
    frame = spark.createDataFrame([(r.sequence_id, r.offset, bytes(r.ids)) for r in packed], "sequence_id long, offset long, ids binary")
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        whole[r.sequence_id] = whole.get(r.sequence_id, b"") + bytes(r.ids)
    assert {r.sequence_id: bytes(r.ids) for r in packing.sequences(frame).collect()} == whole


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    rows = queries.op3_packing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    want = {}
    for doc_id, text in docs:
        ids = library(text) + bytes(4)
        for piece, at in enumerate(range(0, len(ids), 8192)):
            want[doc_id, piece] = (at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192]))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = laid_out((r.sequence_id, r.offset, r.length) for r in rows)
    assert len(sequences) <= sum(r.length for r in rows) / 2048 * 1.02 + 1
