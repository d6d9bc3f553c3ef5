import datetime as dt
import random

import pytest
from test_jobs import FIRST, day, ingest, model, prices_message, symbols  # noqa: F401

from newstide.operators import increments, least_squares
from newstide.plans import jobs
from newstide.plans.jobs import Store
from newstide.schemas import DAY_SUMS, FEATURES, TARGETS
from newstide.sinks import tables
from newstide.sources.tables import read_table

START = dt.date(2024, 1, 1)
ROWS = "symbol string, pub_date date, " + ", ".join(f"{c} double" for c in [*FEATURES, *TARGETS])


def rows_of(seed, days, symbols=6):
    draw, rows = random.Random(seed), []
    for n in days:
        for s in range(symbols):
            x = [float(draw.randrange(2)), draw.uniform(-1, 1), draw.uniform(-3, 3), draw.random(), draw.uniform(50, 400)]
            y = [sum((k + 1) * v for k, v in enumerate(x)) + draw.random() * (t + 1) for t in range(4)]
            rows.append((f"S{s}", START + dt.timedelta(days=n), *x, *y))
    return rows


def predictions(spark, rows, path):
    scored = least_squares.score(spark.createDataFrame(rows, ROWS), path).collect()
    return {(r.symbol, r.pub_date): [r[t] for t in TARGETS] for r in scored}


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], rel=1e-7, abs=1e-6)


@pytest.mark.parametrize("change", [None, "constant", "dependent", "missing"])
def test_sums_of_days_give_the_fit_of_all_rows(spark, tmp_path, change):
    rows = rows_of(1, range(12))
    if change == "constant":
        rows = [(*r[:3], 0.5, *r[4:]) for r in rows]
    if change == "dependent":
        rows = [(*r[:4], 2 * r[3] - 1, *r[5:]) for r in rows]
    if change == "missing":
        rows += [("X", START, None, 1.0, 1.0, 1.0, 9e9, 1.0, 1.0, 1.0, 1.0)]
    table, whole, summed = (str(tmp_path / n) for n in ("sums", "whole", "summed"))
    least_squares.train(spark.createDataFrame(rows, ROWS), whole)
    late = [r for r in rows if r[1].day % 4 == 0]
    # first without some rows of some days, which are entered again whole
    increments.update(spark.createDataFrame([r for r in rows if r not in late[::2]], ROWS), table, "2024-01-05")
    increments.update(spark.createDataFrame(late, ROWS), table, "2024-01-06")
    increments.train(read_table(spark, table, DAY_SUMS), summed)
    complete = [r for r in rows if None not in r]
    same(predictions(spark, complete, summed), predictions(spark, complete, whole))


def test_no_days(spark, tmp_path):
    increments.train(spark.createDataFrame([], DAY_SUMS), str(tmp_path / "m"))
    found = predictions(spark, rows_of(2, [1], 1), str(tmp_path / "m"))
    assert list(found.values()) == [[0.0] * 4]


def test_a_run_enters_its_own_days_only(spark, tmp_path, model):  # noqa: F811
    stores = Store(str(tmp_path / "a")), Store(str(tmp_path / "b"))
    later = [("A", "a3", day(3), "gain"), ("B", "b3", day(0), "gain")]
    for store, from_sums in zip(stores, (True, False)):
        ingest(spark, store, "0", FIRST)
        messages = [prices_message(s, range(0, 9)) for s in ("A", "B")]
        jobs.ingest_prices(spark, store, spark.createDataFrame(messages, "symbol string, message string"), "0")
        assert jobs.run_day(spark, store, day(4), symbols(spark), model, from_sums=from_sums)
        if from_sums:
            before = {str(p) for p in (tmp_path / "a" / "day_sums").rglob("*.parquet")}
        ingest(spark, store, "1", later)
        assert jobs.run_day(spark, store, day(5), symbols(spark), model, from_sums=from_sums)
    sums = stores[0].read(spark, "day_sums").collect()
    assert {(r.pub_date, r.batch_id) for r in sums} == {
        (day(0), "2024-04-05"), (day(2), "2024-04-05"), (day(0), "2024-04-06"), (day(3), "2024-04-06"),
    }
    assert before < {str(p) for p in (tmp_path / "a" / "day_sums").rglob("*.parquet")}
    paths = [jobs.last_model(spark, store, day(5)) for store in stores]
    rows = jobs.training_rows(spark, stores[1], day(5))
    found = [sorted(map(tuple, least_squares.score(rows, p).collect())) for p in paths]
    assert len(found[0]) == 4
    for a, b in zip(*found):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-7, abs=1e-6)
    assert jobs.train_from_sums(spark, stores[0], day(5)) and stores[0].read(spark, "day_sums").count() == 4


def scanned(frame):
    """Rows that the scans of an executed frame have given, after row groups were passed by."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("Adaptive"):
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_passes_by_row_groups(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "guid string, symbol string, n int, pub_date date"
    made = spark.range(40_000).selectExpr(
        "sha2(cast(id as string), 256) as guid", "concat('S', id % 10) as symbol", "cast(id as int) as n",
        "date_add(date'2024-01-01', cast(id % 4 as int)) as pub_date",
    )
    made.sparkSession.conf.set("spark.sql.files.maxRecordsPerFile", 2000)
    try:
        assert tables.append(made, table, "pub_date", cluster=["symbol"], identities=["guid"]) == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    stored = read_table(spark, table, schema)
    known = [r.guid for r in made.where("n in (7, 1234, 39999)").collect()]
    found = tables.with_identity(stored, "guid", known)
    assert sorted(r.n for r in found.collect()) == [7, 1234, 39999]
    # three files of twenty at most hold them, and a false positive or two
    assert scanned(found) <= 5 * 2000 < 40_000
    unknown = tables.with_identity(stored, "guid", [k.replace("a", "b") for k in known])
    assert unknown.count() == 0 and scanned(unknown) <= 2 * 2000
    # rows lie by symbol, so a symbol is in few of a day's files
    assert scanned(stored.where("symbol = 'S3' and pub_date = date'2024-01-04'")) <= 3 * 2000
    many = [r.guid for r in made.where("n < 25").collect()]
    assert tables.with_identity(stored, "guid", many * 2).count() == 25
    assert tables.with_identity(stored, "guid", []).count() == 0


def test_stored_articles(spark, tmp_path):
    store = Store(str(tmp_path))
    ingest(spark, store, "0", FIRST)
    guids = {r.title: r.guid for r in store.read(spark, "news").collect()}
    found = jobs.stored_articles(spark, store, [guids["a1"], guids["b2"], "0" * 64])
    assert sorted(r.title for r in found.collect()) == ["a1", "b2"]
    assert jobs.stored_articles(spark, store, list(guids.values()), [day(2)]).first().title == "b2"
