import hashlib
import random

import numpy as np
import pytest
from llm_cases import ROWS, documents, empty

from newstide.llm import edits, queries


def plain(text):
    """The walk, one step after the other."""
    moves, digits = edits._tables()
    scale, classes, at, out = edits.scale_of(len(text)), edits._classes(text), 0, ""
    chosen = set(edits.steps(scale).tolist())
    for step in range(3 << scale):
        row = step % edits.PERIOD
        if step in chosen:
            out += chr(digits[row, classes[at]]) if at < len(text) else "0"
        if at < len(text):
            at += int(moves[row, classes[at]])
    return f"{scale:02x}{out}"


def test_walks_side_by_side_equal_single_ones():
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdé ñ日") for _ in range(draw.choice([0, 1, 2, 5, 17, 100, 1000, 5000]))) for _ in range(60)]
    assert edits.walks(texts) == [plain(t) for t in texts]
    assert [edits.fingerprint(t) for t in texts[:20]] == [plain(t) for t in texts[:20]]
    assert edits.walks([]) == []


def test_steps_of_a_longer_scale_are_among_those_of_a_shorter():
    for scale in range(4, 16):
        longer = edits.steps(scale + 1)
        assert set(longer[longer < 3 << scale].tolist()) <= set(edits.steps(scale).tolist())
        assert edits.digits_at(edits.fingerprint("ab" * 20), scale + 3).shape == edits.steps(scale + 3).shape


def test_likeness_falls_with_the_number_of_edits():
    draw = random.Random(5)
    means = []
    for number in (0, 1, 5, 25, 100, 400):
        found = []
        for _ in range(25):
            text = "".join(draw.choice("abcdefgh ") for _ in range(1500))
            edited = list(text)
            for _ in range(number):
                at = draw.randrange(len(edited))
                edited[at : at + draw.randint(0, 1)] = draw.choice("abcdefgh") * draw.randint(0, 1)
            found.append(edits.likeness(edits.fingerprint(text), edits.fingerprint("".join(edited))))
        means.append(np.mean(found))
    assert means[0] == 1 and means[1] > 0.9 and all(a > b for a, b in zip(means, means[1:])) and means[-1] < 0.4


def test_empty_and_short_texts():
    assert edits.likeness(edits.fingerprint(""), edits.fingerprint("")) == 1
    assert edits.likeness(edits.fingerprint(""), edits.fingerprint("a")) == 0
    assert 0 <= edits.likeness(edits.fingerprint("a"), edits.fingerprint("b" * 100_000)) <= 1


def followers(rows):
    """The text after each by descending id; rows must have ids that differ."""
    order = sorted(rows, key=lambda r: -r[0])
    return {a[0]: order[(n + 1) % len(order)][1] or "" for n, a in enumerate(order)}


@pytest.mark.parametrize("stretches", [1, 7, 64])
def test_next_document(spark, stretches):
    draw = random.Random(stretches)
    rows = [(i, f"text {i}" if i % 9 else None) for i in draw.sample(range(-500, 10**12), 150)]
    found = edits.followed(documents(spark, rows).repartition(5), stretches).collect()
    assert {r.doc_id: r.next_text for r in found} == followers(rows) and len(found) == len(rows)
    assert {r.doc_id: r.text for r in found} == {i: t or "" for i, t in rows}


def test_repeats_nulls_one_row_and_none(spark):
    found = edits.followed(documents(spark), 4).collect()
    assert sorted(r.text for r in found) == sorted(r.next_text for r in found) == sorted(t or "" for _, t in ROWS)
    assert [(r.text, r.next_text) for r in edits.followed(documents(spark, [(1, "a")]), 8).collect()] == [("a", "a")]
    assert edits.followed(empty(spark), 4).collect() == []
    prints = edits.fingerprints(documents(spark), {"fp": "text"}, {"self": ("fp", "fp")}, "doc_id").collect()
    assert len(prints) == len(ROWS) and all(r.self == 1 for r in prints)


def test_near_groups(spark):
    draw = random.Random(7)
    texts = {}
    for family in range(12):
        text = "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(300, 1200)))
        for n in range(4):
            at = draw.randrange(len(text))
            texts[family * 10 + n] = text[:at] + "z" * n + text[at:]  # up to three letters put in
    rows = [(i, edits.fingerprint(t)) for i, t in texts.items()] + [(3, edits.fingerprint(texts[0]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, fingerprint string")
    group = {r.fingerprint: r.group_id for r in edits.near_groups(frame).collect()}
    found = {i: group[f] for i, f in rows}
    near = [(i, j) for i in texts for j in texts if i < j and edits.likeness(dict(rows)[i], dict(rows)[j]) >= 0.9]
    assert len(near) > 30 and np.mean([found[i] == found[j] for i, j in near]) > 0.9
    assert all(found[i] // 10 == i // 10 for i in texts)  # different texts never meet
    assert edits.near_groups(frame.where("false")).collect() == []


def sharing_one_key(draw):
    """Two near fingerprints that share the first band's key only, and unlike ones that share it too."""
    n, first = len(edits.steps(10)), edits._picked(10)[0]
    written = lambda digits: "0a" + "".join(digits)
    shared = lambda a, b: set(edits.band_keys(written(a))) & set(edits.band_keys(written(b)))
    near = [draw.choice("123456789abcdef") for _ in range(n)]
    other = list(near)
    while len(shared(near, other)) > 1:
        changed = [[*other[:i], "1" if near[i] != "1" else "2", *other[i + 1 :]] for i in range(n) if i not in first]
        other = min(changed, key=lambda c: len(shared(near, c)))
    unlike = [[draw.choice("123456789abcdef") for _ in range(n)] for _ in range(40)]
    for i in first:
        for u in unlike:
            u[i] = near[i]
    return [written(x) for x in (near, other, *unlike)]


@pytest.mark.parametrize("block", [5, 256])
def test_near_texts_meet_whatever_the_leader_of_their_key(spark, block, monkeypatch):
    monkeypatch.setattr(edits, "BLOCK", block, raising=False)
    draw, rows = random.Random(11), []
    for family in range(5):
        rows += [(100 * family + n, p) for n, p in enumerate(sharing_one_key(draw))]
    prints = dict(rows)
    group = {r.fingerprint: r.group_id for r in edits.near_groups(spark.createDataFrame(rows, "doc_id bigint, fingerprint string")).collect()}
    for i, p in rows:
        assert group[p] == (i - 1 if i % 100 == 1 else i)
    for family in range(0, 500, 100):
        assert edits.likeness(prints[family], prints[family + 1]) >= 0.8


def test_a_larger_table_has_longer_keys_and_more_bands():
    assert [edits.digits_for(n) for n in (0, edits.PLAIN, edits.PLAIN + 1, edits.PLAIN * edits.FOLD**3 + 1)] == [6, 6, 7, 10]
    assert edits.bands_for(6) == edits.BANDS
    for digits in range(7, 12):
        assert (1 - edits.NEAR**digits) ** edits.bands_for(digits) <= edits.MISSED
        for bands in (edits._picked(12, digits), edits._border(12, digits)[2]):
            assert bands.shape == (edits.bands_for(digits), digits) and all(len(set(b)) == digits for b in bands.tolist())


def test_near_texts_share_long_keys_and_strangers_do_not():
    draw, shared, strangers, alike = random.Random(17), [], [], random.Random(18)
    n = len(edits.steps(11))
    written = lambda digits: "0b" + "".join(digits)
    for _ in range(300):
        # strangers agree in a fifth of their digits, near texts in 0.8 to 0.85
        text = [draw.choice("123456789abcdef") for _ in range(n)]
        near = [d if alike.random() < 0.81 else draw.choice("123456789abcdef") for d in text]
        stranger = [d if alike.random() < 0.15 else draw.choice("123456789abcdef") for d in text]
        if edits.likeness(written(text), written(near)) >= edits.NEAR:
            shared.append([bool(set(edits.band_keys(written(text), d)) & set(edits.band_keys(written(near), d))) for d in (6, 9)])
        strangers.append([len(set(edits.band_keys(written(text), d)) & set(edits.band_keys(written(stranger), d))) for d in (6, 9)])
    assert len(shared) > 100 and np.mean(shared, axis=0).min() > 0.96
    assert np.sum(strangers, axis=0)[1] <= 1


def test_rows_compared_do_not_grow_with_the_square_of_strangers(spark, monkeypatch):
    """Texts without a near one: 25 times as many share keys by chance about as often each."""
    monkeypatch.setattr(edits, "PLAIN", 80)
    compared, plain_written = {}, edits.written

    def noted(frame, name):
        result = plain_written(frame, name)
        compared[name] = result.count()
        return result

    monkeypatch.setattr(edits, "written", noted)
    draw, shared = random.Random(19), []
    for number in (80, 2000):
        # three digits only, so that strangers agree in a third
        rows = [(i, "0b" + "".join(draw.choice("123") for _ in edits.steps(11))) for i in range(number)]
        groups = edits.near_groups(spark.createDataFrame(rows, "doc_id bigint, fingerprint string")).collect()
        assert sorted(r.group_id for r in groups) == list(range(number))
        shared.append(compared["shared"] / number)
    assert shared[1] < 5 * shared[0]


def test_texts_near_the_threshold_meet_across_scales():
    draw, met = random.Random(13), []
    letters = lambda number: [draw.choice("abcdefgh ") for _ in range(number)]
    for _ in range(1500):
        border = 1 << draw.choice([8, 9, 10])
        text = letters(int(border * draw.uniform(0.93, 0.99)))
        longer = text + letters(int(border * 1.01) - len(text) + 1)
        for _ in range(draw.randint(border // 100, border // 16)):
            longer[draw.randrange(len(longer))] = draw.choice("xyz")
        text = "".join(text)
        a, b = edits.fingerprint(text), edits.fingerprint("".join(longer))
        if 0.8 <= edits.likeness(a, b) < 0.9:
            shared = [k for k in edits.band_keys(a) if k.startswith(f"{int(b[:2], 16)}-")]
            assert len(shared) == edits.BANDS and not any(k.endswith("0") for k in shared)
            met.append(bool(set(edits.band_keys(a)) & set(edits.band_keys(b))))
    assert len(met) > 100 and np.mean(met) > 0.96


def test_near_pairs_of_blocks_equal_single_ones():
    draw = random.Random(12)
    texts = ["".join(draw.choice("ab") for _ in range(draw.choice([0, 1, 17, 30, 35, 60, 70]))) for _ in range(40)]
    prints = [edits.fingerprint(t) for t in texts]
    want = [[edits.likeness(a, b) >= 0.5 for b in prints[7:]] for a in prints[:30] if edits.digits_at(a, 4).any()]
    found = edits.near_pairs(prints[:30], prints[7:], 0.5)
    empty_ones = np.array([[a == b for b in prints[7:]] for a in prints[:30]])  # equal ones are one class
    assert ((found | empty_ones) == np.array(want)).all()


def test_query(spark, sf_dir):
    rows = queries.op9_edit_prints(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    after = followers(list(texts.items()))
    assert len(rows) == len(texts)
    for r in rows:
        text, half = texts[r.doc_id], len(texts[r.doc_id]) // 2
        edited = text[: len(text) - half] + after[r.doc_id][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        if r.doc_id % 10 == 0:
            prints = [edits.fingerprint(t) for t in (text, edited, after[r.doc_id])]
            assert [r.fingerprint, r.edited_fingerprint] == prints[:2]
            assert r.near_edited == edits.likeness(*prints[:2]) and r.near_next == edits.likeness(prints[0], prints[2])
