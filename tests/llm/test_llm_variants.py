import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, empty

from newstide.llm import variants


def at_one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, least=5, commoner=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    counts = {w: n for w, n in counts.items() if n >= least}
    near = {w: [v for v in counts if at_one_edit(v, w)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= commoner * n else None
    found = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        found.add((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return found


def table_of(frame):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


def prose(seed, words=60, docs=120, alphabet="abé"):
    draw = random.Random(seed)
    base = ["".join(draw.choice(alphabet) for _ in range(draw.randint(5, 9))) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    rows = []
    for doc_id in range(docs):
        text = []
        for word in draw.choices(base, weights, k=draw.randint(0, 120)):
            if draw.random() < 0.05:
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "ñ" + word[at + 1 :]])
            text.append(word.upper() if draw.random() < 0.1 else word)
        rows.append((doc_id, draw.choice([" ", ", ", "\n", "1"]).join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rows = prose(seed)
    want = by_hand(rows)
    assert len(want) > 30 and any(r[3] for r in want)
    assert table_of(variants.variants(documents(spark, rows))) == want


def test_forms_follow_one_another_and_ties_go_by_code_points(spark):
    names = {"planets": 5, "planetas": 25, "planetaso": 125, "planetasom": 625, "planetasomb": 3125}
    names |= {"gardenz": 5, "gardens": 25, "gardené": 25, "garden": 25}
    text = " ".join(" ".join([w] * n) for w, n in names.items())
    # an id under which no run loses a letter
    whole = next(i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 199 for w in names))
    found = {r.word: r for r in variants.variants(documents(spark, [(whole, text)])).collect()}
    assert found["planets"].root == "planetasomb" and found["planets"].form == "planetas"
    assert found["gardenz"].form == "garden" and found["gardenz"].n_near == 3
    assert found["garden"].form is None and found["garden"].root == "garden"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("abé", min_size=2, max_size=7), unique=True, max_size=40))
def test_no_pair_is_lost_or_doubled(spark, words):
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    pairs = [frozenset((r.a, r.b)) for r in variants.near_pairs(frame).collect()]
    assert Counter(pairs) == Counter({frozenset((a, b)): 1 for a in words for b in words if a < b and at_one_edit(a, b)})


def test_tables(spark, monkeypatch):
    monkeypatch.setattr(variants, "COUNTED", 3)
    rows = [(1, "Station station STATION"), (1, "Station station STATION"), (None, "station stations"), (None, None), (2, ""),
            (3, "stations " * 30_000), (4, "Ünder Übergang ÜBERGANG ×÷ übergang " * 4)]
    assert table_of(variants.variants(documents(spark, rows))) == by_hand(rows)
    assert variants.variants(empty(spark)).collect() == []
