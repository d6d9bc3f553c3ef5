import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newstide.operators import forecast, gated_cell, least_squares, naive_bayes, texts
from newstide.plans import queries
from newstide.schemas import FEATURES, TARGETS


def labelled(spark):
    rows = [(1, True, ["up", "up", "gain"]), (2, True, ["gain"]), (3, False, ["loss", "up"])]
    return texts.with_terms(spark.createDataFrame(rows, "doc_id bigint, positive boolean, tokens array<string>"))


def test_bayes_by_hand(spark, tmp_path):
    naive_bayes.train(labelled(spark), str(tmp_path))
    model = naive_bayes.load(spark, str(tmp_path))
    assert (model.pos_docs, model.neg_docs, model.pos_tokens, model.neg_tokens, model.vocabulary) == (2, 1, 4, 2, 3)
    docs = spark.createDataFrame(
        [(1, ["loss", "loss"]), (2, []), (3, ["unheard"]), (4, ["up", "gain"])], "doc_id bigint, tokens array<string>"
    )
    got = {r.doc_id: r for r in naive_bayes.score(texts.with_terms(docs), model, "doc_id").collect()}
    prior = math.log(2) - math.log(1)
    weight = lambda p, n: math.log((p + 1) / 7) - math.log((n + 1) / 5)
    assert got[1].margin == pytest.approx(prior + 2 * weight(0, 1)) and got[1].sentiment == "negative"
    assert got[2].margin == pytest.approx(prior) and got[2].sentiment == "positive"
    assert got[3].margin == pytest.approx(prior)
    assert got[4].margin == pytest.approx(prior + weight(2, 1) + weight(2, 0))


def test_bag_of_words_within_a_vocabulary(spark):
    vocabulary = spark.createDataFrame([("up",), ("loss",)], "token string")
    rows = texts.bag_of_words(labelled(spark), vocabulary).select("doc_id", "token", "n").collect()
    assert sorted(map(tuple, rows)) == [(1, "up", 2), (3, "loss", 1), (3, "up", 1)]


def test_texts_are_worked_through_once(spark):
    """No hidden filter repeats the cleaning below the rows made from it."""
    docs = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    plan = texts.term_rows(texts.with_terms(texts.with_stems(docs)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


@pytest.mark.parametrize("name", ["bag_of_words", "nb_predict", "predicted_daily_sentiment"])
def test_a_model_and_its_use_clean_the_texts_once(spark, sf_dir, monkeypatch, name):
    calls, own = [], texts.with_stems
    monkeypatch.setattr(texts, "with_stems", lambda *given: calls.append(given) or own(*given))
    frame = queries.QUERIES[name](spark, sf_dir)
    assert len(calls) == 1 and "regexp_extract_all" not in frame._jdf.queryExecution().executedPlan().toString()


def sample(spark, n=60):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        x = [rng.randint(0, 1), rng.uniform(-1, 1), rng.uniform(-2, 2), rng.random(), rng.uniform(10, 20)]
        y = [x[4] + 1, x[4] - x[1], 2 * x[4] + x[0], 100 + 3 * x[2]]
        rows.append((f"S{i % 4}", dt.date(2024, 1, 1) + dt.timedelta(days=i), *x, *y))
    schema = "symbol string, pub_date date, sentiment int, " + ", ".join(f"{c} double" for c in FEATURES[1:] + TARGETS)
    return spark.createDataFrame(rows, schema), rows


@pytest.mark.parametrize("model", [least_squares, forecast])
def test_linear_forecast_equals_least_squares(spark, tmp_path, model):
    frame, rows = sample(spark)
    model.train(frame, str(tmp_path))
    got = {(r.symbol, r.pub_date): [r[t] for t in TARGETS] for r in model.score(frame, str(tmp_path)).collect()}
    x = np.array([[1.0, *r[2:7]] for r in rows])
    y = np.array([r[7:] for r in rows])
    want = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert all(np.allclose(got[r[0], r[1]], w, atol=1e-6) for r, w in zip(rows, want))


def test_boosted_trees_learn_the_targets(spark, tmp_path):
    frame, rows = sample(spark)
    forecast.train(frame, str(tmp_path), regressor=lambda t: forecast.boosted_trees(t, rounds=3))
    scored = forecast.score(frame, str(tmp_path)).select("symbol", "pub_date", F.col("high").alias("predicted"))
    error, spread = scored.join(frame, ["symbol", "pub_date"]).agg(
        F.avg(F.abs(F.col("predicted") - F.col("high"))), F.stddev("high")
    ).first()
    assert error < spread


def test_gated_cell_equals_a_full_cell_with_zero_state():
    rng = np.random.default_rng(1)
    flat, x = rng.normal(size=gated_cell.N_PARAMETERS), rng.normal(size=(6, 5))
    w, b, wd, bd = gated_cell.unpack(flat)
    (wi, wg, wo), (bi, bg, bo) = np.split(w, 3, axis=1), np.split(b, 3)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    recurrent, forget = rng.normal(size=(50, 50)), rng.normal(size=(5, 50))
    h = c = np.zeros((6, 50))
    gate = lambda w, b: x @ w + h @ recurrent + b
    c = sigmoid(gate(forget, 1.0)) * c + sigmoid(gate(wi, bi)) * np.tanh(gate(wg, bg))
    want = sigmoid(gate(wo, bo)) * np.tanh(c) @ wd + bd
    assert gated_cell.N_PARAMETERS == 1104
    assert np.allclose(gated_cell.forward(x, flat)[0], want)


def test_gated_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    flat, x, y = rng.normal(size=gated_cell.N_PARAMETERS) / 3, rng.normal(size=(4, 5)), rng.normal(size=(4, 4))
    _, gradient = gated_cell.loss_gradient(x, y, flat)
    for i in rng.choice(len(flat), 40, replace=False):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        slope = (gated_cell.loss_gradient(x, y, flat + step)[0] - gated_cell.loss_gradient(x, y, flat - step)[0]) / 2e-6
        assert slope == pytest.approx(gradient[i], abs=1e-5)


def test_gated_training_takes_the_same_steps_for_any_number_of_tasks(spark, tmp_path):
    frame, rows = sample(spark, 24)
    losses = gated_cell.train(frame, str(tmp_path / "a"), steps=6)
    x = np.array([r[2:7] for r in rows], float)
    x, y = (x - x.min(0)) / (x.max(0) - x.min(0)), np.array([r[7:] for r in rows])
    adam = gated_cell.Adam(gated_cell.initial_parameters(), 0.05)
    for _ in range(6):
        adam.step(gated_cell.loss_gradient(x, y, adam.flat)[1] / len(x))
    learned = gated_cell.load_parameters(spark, str(tmp_path / "a/parameters"))
    assert np.allclose(learned, adam.flat) and losses[-1] < losses[0]
    gated_cell.train(frame.repartition(5), str(tmp_path / "b"), steps=6)
    assert np.allclose(gated_cell.load_parameters(spark, str(tmp_path / "b/parameters")), learned)
    # going on from there goes on learning
    more = gated_cell.train(frame, str(tmp_path / "c"), previous=str(tmp_path / "a"), steps=3)
    assert more[0] < losses[-1]
    scored = gated_cell.score(frame.drop(*TARGETS), str(tmp_path / "a"))
    assert scored.columns == ["symbol", "pub_date", *TARGETS]
    got = {(r[0], r[1]): r[2:] for r in map(tuple, scored.collect())}
    want, _ = gated_cell.forward(x, learned)
    assert all(np.allclose(got[r[0], r[1]], w) for r, w in zip(rows, want))


@pytest.mark.parametrize("model", [least_squares, forecast, gated_cell])
def test_incomplete_rows_are_not_trained_on(spark, tmp_path, model):
    frame, _ = sample(spark, 30)
    holes = frame.limit(4).withColumns({"open": F.lit(None).cast("double"), "volume": F.lit(None).cast("double")})
    model.train(frame, str(tmp_path / "a"))
    model.train(frame.unionByName(holes), str(tmp_path / "b"))
    a, b = (
        {(r.symbol, r.pub_date): [r[t] for t in TARGETS] for r in model.score(frame, str(tmp_path / n)).collect()}
        for n in "ab"
    )
    assert all(np.allclose(a[k], b[k]) and np.isfinite(a[k]).all() for k in a)


def test_bag_of_words_keeps_a_row_per_document_and_term(spark, sf_dir):
    """Rows of single terms, and not sums of a document's."""
    rows = queries.bag_of_words(spark, sf_dir)
    assert rows.columns == ["doc_id", "token", "n"]
    counts = rows.agg(F.count("*"), F.countDistinct("doc_id", "token"), F.countDistinct("doc_id")).first()
    assert counts[0] == counts[1] > 10 * counts[2]
