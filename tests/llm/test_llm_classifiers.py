"""Language, quality, pseudo-likelihood."""

import random

import numpy as np
import pytest
from llm_cases import ROWS, documents, empty
from pyspark.sql import functions as F

from newstide.llm import languages, pseudo_likelihood, quality, queries
from newstide.llm.common import crc_hash, fold

# --- language ---------------------------------------------------------------------------


def test_filters_have_no_false_negatives_and_the_expected_false_positives():
    draw = np.random.default_rng(1)
    members = {name: draw.integers(0, 2**63, 20_000, dtype=np.uint64) for name in ("a", "b", "c")}
    filters = languages.Filters.of(members)
    for bit, own in enumerate(members.values()):
        assert (filters.found(own) >> np.uint64(bit) & np.uint64(1)).all()
    others = draw.integers(0, 2**63, 200_000, dtype=np.uint64)
    masks = filters.found(others)
    for bit, chance in enumerate(filters.chance):
        assert (masks >> np.uint64(bit) & np.uint64(1)).mean() == pytest.approx(chance, rel=0.1)


def test_grams_by_hand():
    def by_hand(text):
        padded = f" {''.join(c if c.isalpha() else ' ' for c in text.lower())} "
        found = []
        for size in languages.SIZES:
            for i in range(len(padded) - size + 1):
                gram = padded[i : i + size]
                if " " not in (gram if size == 2 else gram[1:-1]):
                    found.append(gram)
        return found

    # equal n-grams have equal hashes, different ones different hashes
    for text in ("Ab, é ab!", "x", "", "one two three", "a" * 50):
        assert len(languages.grams(text)) == len(by_hand(text))
        assert len(set(languages.grams(text).tolist())) == len(set(by_hand(text)))


def test_more_languages_than_bits_of_a_word():
    draw = np.random.default_rng(1)
    members = {f"l{i:03d}": draw.integers(0, 2**63, 300, dtype=np.uint64) for i in range(130)}
    members["l129"] = languages.grams("the quick brown fox jumps over the lazy dog")
    filters = languages.Filters.of(members)
    assert filters.slots.shape[0] == 3 and len(filters.chance) == 130
    for bit, own in enumerate(members.values()):
        assert (filters.found(own)[bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).all()
    assert filters.predict("the brown dog", filters.chance)[0] == "l129"


def test_marks_alone_are_no_letter():
    filters = languages.Filters.of({"a": languages.grams("the quick brown fox")})
    assert filters.predict("\u0301\u0302 \u0301", filters.chance) == ("und", 0.0, 0.0)
    assert filters.predict("e\u0301", filters.chance)[0] == "a"


def test_counts_of_long_texts_in_stretches(monkeypatch):
    filters = languages.Filters.of({"a": languages.grams("the quick brown fox"), "b": languages.grams("der schnelle fuchs")})
    text = "the quick fuchs and der brown fox. " * 30
    whole = filters.counts(text)
    monkeypatch.setattr(languages, "STRETCH", 50)
    assert filters.counts(text)[0].tolist() == whole[0].tolist() and filters.counts(text)[1] == whole[1]


def test_language_of_odd_rows(spark):
    train = [(i, f"the cat and the dog number {i}", "en") for i in range(30)] + [(100 + i, f"der hund und die katze {i}", "de") for i in range(30)]
    known = spark.createDataFrame([*train, (200, "x", None), (201, None, "en")], "doc_id long, text string, lang string")
    filters = languages.learn(known)
    assert filters.languages == ["de", "en"]
    found = languages.predict(documents(spark), filters, "doc_id", "text").collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 and 0 <= r.coverage <= 1 for r in found)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert languages.predict(empty(spark), filters, "doc_id").collect() == []
    nothing = languages.learn(known.where("false"))
    assert {r.lang_pred for r in languages.predict(documents(spark), nothing, "doc_id").collect()} == {"und"}
    kept = languages.accepted(documents(spark), filters)
    assert kept.columns == documents(spark).columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_only_the_text_decides_and_held_out_accuracy(spark, sf_dir):
    rows = queries.op8_language(spark, sf_dir.replace("0.001", "0.01")).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.held_out == (crc_hash(str(r.doc_id)) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98
    by_text = {}
    for r in rows:
        by_text.setdefault(docs[r.doc_id].text, set()).add((r.lang_pred, r.score))
    assert all(len(v) == 1 for v in by_text.values())


def test_fold(spark):
    found = spark.createDataFrame([(i,) for i in (0, 1, -5, 10**12, None)], "i long").select("i", fold(F.col("i"), 7).alias("f"))
    assert [(r.i, r.f) for r in found.collect()] == [(i, crc_hash(str(i)) % 7 if i is not None else None) for i in (0, 1, -5, 10**12, None)]


# --- quality ----------------------------------------------------------------------------


def machine(seed=3):
    draw = np.random.default_rng(seed)
    size = quality.BUCKETS + len(quality.STATISTICS)
    return quality.Machine(
        0.3, draw.normal(size=size), draw.normal(0, 0.3, (size, quality.RANK)),
        draw.normal(size=len(quality.STATISTICS)), draw.random(len(quality.STATISTICS)) + 0.5,
    )


def test_pairs_in_linear_time_equal_all_pairs():
    own = machine()
    found = [quality.features(t) for t in ("a b a c", "", "x " * 30 + "!!", "one two. Three | four")]
    ids, values, starts = own.rows(found)
    margins, _ = own.margins(ids, values, starts)
    for n, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
        i, x = ids[start:end], values[start:end]
        pairs = sum(own.factors[i[a]] @ own.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert margins[n] == pytest.approx(own.bias + own.linear[i] @ x + pairs)


def test_training_learns_an_interaction():
    """Two words that are good together or apart: no sum of single weights can tell."""
    draw, texts, labels = random.Random(1), [], []
    for _ in range(800):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        filler = [f"w{draw.randint(0, 30)}" for _ in range(6)]
        texts.append(" ".join([*filler, "left" if a else "right", "up" if b else "down"]))
        labels.append(float(a == b))
    found = [quality.features(t) for t in texts]
    learned = quality.train(found[:600], np.array(labels[:600]), np.ones(600))
    assert np.mean((learned.scores(found[600:]) >= 0.5) == np.array(labels[600:])) > 0.9


def test_quality_of_odd_rows(spark):
    own = machine()
    found = quality.score(documents(spark), own, "doc_id", "text").collect()
    assert len(found) == len(ROWS)
    assert all(r.score == pytest.approx(own.scores([quality.features(r.text or "")])[0]) for r in found)
    assert quality.score(empty(spark), own, "doc_id").collect() == []
    docs = documents(spark)
    for rows, score in (([], 1.0), ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([(None, 0), (1, None), (2, 1), (3, 7)], 1.0)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        scores = quality.score(docs, quality.learn(docs, labels), "doc_id").collect()
        assert all(r.score == pytest.approx(score) for r in scores)
    kept = quality.accepted(docs, own, 0.5)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.5 for r in found)


def test_held_out_quality(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in queries.op10_quality(spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (crc_hash(str(i)) % 3 == 1) and r.predicted == int(r.score >= 0.5) for i, r in rows.items())
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97


# --- pseudo-likelihood ------------------------------------------------------------------


def structured(number, seed=1):
    """Texts in which a word follows from its neighbours."""
    draw = random.Random(seed)
    cycle = [f"word{i}" for i in range(12)]
    return [" ".join(cycle[(s + i) % 12] for i in range(draw.randint(5, 60))) for s in (draw.randrange(12) for _ in range(number))]


def test_the_network_predicts_from_both_sides(spark):
    texts = structured(300)
    model = pseudo_likelihood.learn(documents(spark, list(enumerate(texts))))
    shuffled = [" ".join(random.Random(i).sample(t.split(), len(t.split()))) for i, t in enumerate(texts)]
    right, wrong = (model.score([pseudo_likelihood.buckets(t) for t in own]) for own in (texts, shuffled))
    assert (right > wrong).mean() > 0.95
    # the probabilities of all words at a place sum to one
    every = np.arange(len(model.vocabulary))
    for sides in ([0, 1, 2, 3], [len(every)] * 4, [5, 5, len(every), 200]):
        assert np.exp(model.network.logs(np.tile(sides, (len(every), 1)), every)).sum() == pytest.approx(1, abs=1e-3)
    counts = pseudo_likelihood.word_counts(documents(spark, list(enumerate(texts))))
    assert counts.sum() == sum(len(t.split()) for t in texts)


def two_rare_words():
    """Texts with two words of equal frequency, each of which stands beside words of its own."""
    draw, common = random.Random(3), [f"common{i}" for i in range(40)]
    texts = []
    for i in range(400):
        own = draw.choices(common, k=20)
        own[10:10] = ["north", "rarea", "south"] if i % 2 else ["east", "rareb", "west"]
        texts.append(" ".join(own))
    return texts


def test_exchanging_rare_words_of_equal_frequency_changes_the_score(spark):
    texts = two_rare_words()
    model = pseudo_likelihood.learn(documents(spark, list(enumerate(texts))))
    exchange = {"rarea": "rareb", "rareb": "rarea"}
    exchanged = [" ".join(exchange.get(w, w) for w in t.split()) for t in texts]
    right, wrong = (model.score([pseudo_likelihood.buckets(t) for t in own]) for own in (texts, exchanged))
    assert (right > wrong + 1).all()


def test_several_trainers_learn_together(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "TRAINER", 3000)
    texts = two_rare_words()
    docs = documents(spark, list(enumerate(texts)))
    vocabulary = pseudo_likelihood.Vocabulary.of(pseudo_likelihood.word_counts(docs))
    start, network = pseudo_likelihood.Network(vocabulary.counts), pseudo_likelihood.trained(docs, vocabulary)
    sides, own = vocabulary.contexts([pseudo_likelihood.buckets(t) for t in texts])
    assert network.logs(sides, own).mean() > start.logs(sides, own).mean() + 0.05
    model, exchange = pseudo_likelihood.Model(vocabulary, network), {"rarea": "rareb", "rareb": "rarea"}
    exchanged = [" ".join(exchange.get(w, w) for w in t.split()) for t in texts]
    right, wrong = (model.score([pseudo_likelihood.buckets(t) for t in own]) for own in (texts, exchanged))
    assert (right > wrong).mean() > 0.95


def test_positions_grow_with_the_corpus(spark, monkeypatch):
    texts = structured(200)
    docs = documents(spark, [*enumerate(texts), (900, None), (901, "")])
    words = sum(len(t.split()) for t in texts)
    vocabulary = pseudo_likelihood.Vocabulary.of(pseudo_likelihood.word_counts(docs))
    found = [tuple(r.place) for r in pseudo_likelihood.positions(docs, vocabulary).collect()]
    end, want = len(vocabulary), []
    for text in texts:
        ids = [end, end, *vocabulary.ids(pseudo_likelihood.buckets(text)).tolist(), end, end]
        want += [(*ids[i - 2 : i], *ids[i + 1 : i + 3], ids[i]) for i in range(2, len(ids) - 2)]
    assert sorted(found) == sorted(want) and len(found) == words
    monkeypatch.setattr(pseudo_likelihood, "LEAST", 100)
    monkeypatch.setattr(pseudo_likelihood, "SHARE", 4)
    assert pseudo_likelihood.positions(docs, vocabulary).count() == pytest.approx(words / 4, rel=0.2)


def test_every_position_is_learnt_from(spark, monkeypatch):
    """More words than any least number, and none is left out."""
    monkeypatch.setattr(pseudo_likelihood, "LEAST", 10)
    docs = documents(spark, [(i, " ".join(f"w{(i * k) % 97}" for k in range(200))) for i in range(60)])
    vocabulary = pseudo_likelihood.Vocabulary.of(pseudo_likelihood.word_counts(docs))
    found = np.bincount([r.place[-1] for r in pseudo_likelihood.positions(docs, vocabulary).collect()], minlength=len(vocabulary))
    assert found.tolist() == vocabulary.counts.tolist() and found.sum() == 60 * 200


def test_words_are_found_once_and_are_those_of_each_text(spark):
    odd = ["", " ", " a  b ", "Σας ΣΑΣ ΟΔΟΣ a", "İstanbul I\x1cb\x1fc\x85d\u2028e\u3000f\u00a0g\u200bh\x0bi\x0cj\x1dk\x1el", "\n\tx\r\ny\n", "ẞ ǅ ﬁ \ud7ff", "a\x00b c"]
    rows = [*ROWS[:7], *ROWS[8:], *enumerate(odd, 500), (600, None)]
    docs = documents(spark, rows)
    found = pseudo_likelihood.worded(docs)
    got = sorted((r.doc_id or 0, np.frombuffer(r[pseudo_likelihood.WORDS], dtype="<u2").tolist()) for r in found.collect())
    assert got == sorted((i or 0, pseudo_likelihood.buckets(t or "").tolist()) for i, t in rows)
    model = pseudo_likelihood.learn(found)
    scored = [{(r.doc_id, r.n_tokens): r.log_likelihood for r in pseudo_likelihood.score(d, model).collect()} for d in (docs, found)]
    assert scored[0].keys() == scored[1].keys() and all(scored[1][k] == pytest.approx(v) for k, v in scored[0].items())
    assert (pseudo_likelihood.word_counts(docs) == pseudo_likelihood.word_counts(found)).all()


def test_the_query_splits_the_texts_once(spark, sf_dir, monkeypatch):
    given, plain = [], pseudo_likelihood.learn
    monkeypatch.setattr(pseudo_likelihood, "learn", lambda docs: given.append(docs.columns) or plain(docs))
    rows = queries.op7_pseudo_likelihood(spark, sf_dir).select("n_tokens").collect()
    assert given == [["doc_id", pseudo_likelihood.WORDS]] and len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_vocabulary():
    counts = np.zeros(pseudo_likelihood.MOST, dtype=np.int64)
    counts[[5, 300, 700, 261]] = [3, 9, 1, 4]
    small = pseudo_likelihood.Vocabulary.of(counts)
    # 5 and 261 share a bucket of 256
    assert len(small) == 256 and small.counts[:3].tolist() == [9, 7, 1] and small.ids(np.array([300, 261, 5]))[1:].tolist() == [1, 1]
    assert len(pseudo_likelihood.Vocabulary.of(np.ones(pseudo_likelihood.MOST, dtype=np.int64))) == pseudo_likelihood.MOST


def test_scores_by_hand(spark):
    rows = [*ROWS[:7], *ROWS[8:], *((50 + i, t) for i, t in enumerate(structured(20)))]
    docs = documents(spark, rows)
    model = pseudo_likelihood.learn(docs)
    found = pseudo_likelihood.score(docs.repartition(3), model).collect()
    vectors, words, groups, inner = (m.astype(float) for m in model.network.parts(model.network.own))
    softmax = lambda x: x - np.log(np.exp(x).sum())
    end, want = len(model.vocabulary), []
    for doc_id, text in rows:
        ids, total = model.vocabulary.ids(pseudo_likelihood.buckets(text or "")).tolist(), 0.0
        around = [end, end, *ids, end, end]
        for i, own in enumerate(ids):
            seen = np.concatenate([vectors[around[i + 2 + o]] for o in (-2, -1, 1, 2)])
            hidden = np.tanh(seen @ inner[:-1] + inner[-1])
            group = own // pseudo_likelihood.GROUP
            members = words[group * pseudo_likelihood.GROUP : (group + 1) * pseudo_likelihood.GROUP]
            total += softmax(groups[:, :-1] @ hidden + groups[:, -1])[group]
            total += softmax(members[:, :-1] @ hidden + members[:, -1])[own % pseudo_likelihood.GROUP]
        want.append((doc_id or 0, len(ids), total))
    got = sorted((r.doc_id or 0, r.n_tokens, r.log_likelihood) for r in found)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert np.allclose([g[2] for g in got], [w[2] for w in sorted(want)], rtol=1e-4, atol=1e-4)


def test_long_texts_and_empty_tables(spark, monkeypatch):
    docs = documents(spark)
    model = pseudo_likelihood.learn(docs)
    whole = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score(docs, model).collect()}
    assert whole[3] == 0 and whole[5] < 0
    monkeypatch.setattr(pseudo_likelihood, "SCORED", 1000)
    monkeypatch.setattr(pseudo_likelihood, "BLOCK", 7)
    own = [pseudo_likelihood.buckets(dict(ROWS)[5])]
    assert model.score(own)[0] == pytest.approx(whole[5], rel=1e-3)
    assert pseudo_likelihood.score(empty(spark), pseudo_likelihood.learn(empty(spark))).collect() == []


def test_gradient_is_the_slope_of_the_loss():
    draw = np.random.default_rng(2)
    network = pseudo_likelihood.Network(draw.integers(0, 50, 512))
    network.own = network.own.astype(np.float64)
    sides, own = draw.integers(0, 513, (60, 4)), draw.integers(0, 512, 60)
    slope = network.slopes(sides, own)
    chosen = np.flatnonzero(slope)
    for at in [*draw.choice(chosen, 40), *range(slope.size - pseudo_likelihood.WIDTH * 3, slope.size, 9)]:
        at = np.unravel_index(at, slope.shape)
        values = []
        for step in (1e-4, -1e-4):
            network.own[at] += step
            _, words, groups, _ = network.parts(network.own)
            hidden = network.hidden(sides)[1]
            scores = hidden @ groups[:, :-1].T + groups[:, -1]
            total = (scores[np.arange(60), own // 256] - np.log(np.exp(scores).sum(1))).sum()
            for i, w in enumerate(own):
                members = words[w // 256 * 256 :][:256]
                scores = members[:, :-1] @ hidden[i] + members[:, -1]
                total += scores[w % 256] - np.log(np.exp(scores).sum())
            values.append(-total)
            network.own[at] -= step
        assert (values[0] - values[1]) / 2e-4 == pytest.approx(slope[at], abs=1e-3, rel=1e-3)


def test_scores_reuse_one_small_block(monkeypatch):
    """All chances of a softmax go through one block of at most 128 KB, however many positions a group has."""
    draw, blocks, plain = np.random.default_rng(5), [], np.exp
    network = pseudo_likelihood.Network(draw.integers(0, 50, 1024))
    sides, own = draw.integers(0, 1025, (3000, 4)), np.minimum(draw.integers(0, 2000, 3000), 1023)
    monkeypatch.setattr(np, "exp", lambda x, *rest, **named: blocks.append((x.ctypes.data, x.nbytes)) or plain(x, *rest, **named))
    for work in (network.logs, network.slopes):
        blocks.clear()
        work(sides, own)
        # a block for the groups and one for the words, each of 3,000 positions and 256 scores
        assert len({at for at, _ in blocks}) <= 2 and max(size for _, size in blocks) <= 1 << 17
        assert sum(size for _, size in blocks) == 3000 * 4 * (4 + pseudo_likelihood.GROUP)


def test_steps_use_the_same_memory(monkeypatch):
    """What an earlier step, larger or smaller, left in the memory does not count."""
    draw = np.random.default_rng(6)
    network, room = pseudo_likelihood.Network(draw.integers(0, 50, 512)), pseudo_likelihood.Room()
    sides, own = draw.integers(0, 513, (2000, 4)).astype(np.int32), draw.integers(0, 512, 2000).astype(np.int32)
    for end in (2000, 70, 1300, 1, 2000):
        for work in (network.slopes, network.logs):
            assert np.allclose(work(sides[:end], own[:end], room), work(sides[:end], own[:end]), rtol=1e-4, atol=1e-4)
    given, plain = [], network.slopes
    monkeypatch.setattr(network, "slopes", lambda *rest: given.append(rest[2]) or plain(*rest))
    network.train(sides, own)
    assert len(given) == pseudo_likelihood.STEPS and len({id(x) for x in given}) == 1
