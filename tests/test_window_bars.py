import datetime as dt
import json
import random
import threading
import time

import pytest
from test_streaming import T, land, trade

from newstide import schemas
from newstide.plans.jobs import Store, compact_trades, run_trades, trades
from newstide.sources.streams import file_messages, table_rows
from newstide.sources.tables import read_table
from newstide.streaming import bars, ticks

START = dt.datetime(2024, 5, 1)
TICKS = "symbol string, ts timestamp, price double, volume double, seq bigint"


def tick(seq, minute, symbol="A", price=None):
    return (symbol, START + dt.timedelta(minutes=minute), float(seq if price is None else price), 2.0, seq)


def test_bars_of_batches_late_trades_and_a_restart(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "bars", "cp"))

    def run(*rows):
        if rows:
            spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(folder)
        arriving = table_rows(spark, folder, spark.createDataFrame([], TICKS).schema, files_per_batch=1)
        query = bars.write_window_bars(arriving, table, checkpoint, "1 hour", "30 minutes")
        query.awaitTermination()
        return query

    first = [tick(2, 5), tick(1, 9, price=7.5), tick(3, 61), tick(1, 10, "B")]
    run(*first)
    # within the delay: the open window's first price changes, as the earlier number decides
    second = [tick(0, 59, price=0.5), tick(9, 200)]
    run(*second)
    # the newest trade is at 200 minutes: windows that end before 170 are closed
    third = [tick(8, 30, price=99.0), tick(7, 199, price=3.0), tick(6, 100, "B")]
    query = run(*third)
    run()
    now = bars.current_bars(read_table(spark, table, schemas.WINDOW_BARS))
    rows = {(r.symbol, r.start): tuple(r)[2:] for r in now.collect()}
    timely = spark.createDataFrame([*first, *second, third[1]], TICKS)
    assert rows == {(r.symbol, r.start): tuple(r)[2:] for r in bars.window_bars(timely, "1 hour").collect()}
    assert rows["A", START] == (0.5, 7.5, 0.5, 2.0, 6.0, 3)
    late = bars.late_trades(spark.createDataFrame([*first, *second, *third], TICKS), now, "1 hour")
    assert sorted((r.symbol, r.start, r.late) for r in late.collect()) == [("A", START, 1), ("B", START + dt.timedelta(hours=1), 1)]
    # closed windows have left the state
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_a_replayed_batch_writes_the_same_rows(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "bars", "cp"))
    spark.createDataFrame([tick(1, 5), tick(2, 70)], TICKS).coalesce(1).write.parquet(folder)

    def run():
        arriving = table_rows(spark, folder, spark.createDataFrame([], TICKS).schema)
        bars.write_window_bars(arriving, table, checkpoint, "1 hour", "1 day").awaitTermination()
        return sorted(map(tuple, read_table(spark, table, schemas.WINDOW_BARS).collect()))

    before = run()
    # as if the last batch had been written but not entered as done
    for entry in (tmp_path / "cp" / "commits").iterdir():
        entry.unlink()
    assert run() == before and len(before) == 2


def messages(path, name, rows):
    land(path, name, [(n, [trade(s, p, t)]) for n, (s, p, t) in rows])


def test_settled_trades_are_the_last_writes_and_the_state_stays_small(spark, tmp_path):
    landed, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    draw, everything, number, sizes = random.Random(2), [], 0, []

    def run():
        query = ticks.settle_trades(file_messages(spark, str(landed)), table, checkpoint, "10 seconds")
        query.awaitTermination()
        sizes.extend(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])

    for batch in range(5):
        rows = []
        for _ in range(60):
            rows.append((number, (draw.choice("AB"), float(number), T + batch * 10_000 + draw.randrange(100) * 100)))
            number += 1
        messages(landed, f"{batch}.json", rows)
        everything += rows
        run()
    run()
    found = read_table(spark, table, schemas.TRADES).collect()
    newest = max(t for _, (_, _, t) in everything) - 10_000
    want = {(s, t): p for _, (s, p, t) in sorted(everything) if t <= newest}
    assert len(found) == len(want) and {(r.symbol, int(r.ts.replace(tzinfo=dt.UTC).timestamp() * 1000)): r.price for r in found} == want
    # a batch brings 60 trades and at most two batches are within the delay
    assert max(sizes) <= 120
    # as if the last batch had not been entered as done
    last = max(int(p.name) for p in (tmp_path / "cp" / "commits").glob("[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    run()
    assert sorted(map(tuple, read_table(spark, table, schemas.TRADES).collect())) == sorted(map(tuple, found))


def test_late_trades_of_compacted_days_are_seen(spark, tmp_path):
    landed, store, day_ms = tmp_path / "landed", Store(str(tmp_path / "store")), 86_400_000

    def take_in(name, *rows):
        land(landed, name, [(n, {"data": [trade(p=p, t=t)], "type": "trade"}) for n, p, t in rows])
        return sorted((r.price, r.ts.day) for r in run_trades(spark, store, str(landed)).collect())

    assert take_in("1", (1, 1.0, T), (2, 2.0, T + day_ms), (3, 9.0, T + 2 * day_ms)) == [(1.0, 30), (2.0, 1), (9.0, 2)]
    compact_trades(spark, store, dt.date(2024, 5, 2))
    assert sorted(r.price for r in trades(spark, store).collect()) == [1.0, 2.0, 9.0]
    # a new key and a later write of a compacted one
    assert take_in("2", (4, 3.0, T + 1), (5, 4.0, T + day_ms)) == [(1.0, 30), (3.0, 30), (4.0, 1), (9.0, 2)]
    compact_trades(spark, store, dt.date(2024, 5, 2))
    assert take_in("3") == [(1.0, 30), (3.0, 30), (4.0, 1), (9.0, 2)]
    assert take_in("4", (6, 5.0, T)) == [(3.0, 30), (4.0, 1), (5.0, 30), (9.0, 2)]


def test_batches_of_compacted_days_are_not_read_again(spark, tmp_path):
    landed, store = tmp_path / "landed", Store(str(tmp_path / "store"))
    land(landed, "1", [(1, {"data": [trade()], "type": "trade"})])
    run_trades(spark, store, str(landed))
    compact_trades(spark, store, dt.date(2024, 6, 1))
    for file in (tmp_path / "store" / "trades").rglob("*.parquet"):
        file.write_bytes(b"no parquet")
    assert trades(spark, store).count() == 1


def test_compacting_before_any_trade(spark, tmp_path):
    store = Store(str(tmp_path))
    compact_trades(spark, store, dt.date(2024, 6, 1))
    assert trades(spark, store).count() == 0


@pytest.mark.parametrize("landings", [1, 2])
def test_a_silent_stream_stops_and_goes_on_where_it_was(spark, tmp_path, landings):
    landed, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    messages(landed, "0.json", [(0, ("A", 1.0, T))])

    def later():
        for n in range(1, landings):
            time.sleep(2)
            messages(landed, f"{n}.json", [(n, ("A", n + 1.0, T + n))])

    def run():
        query = ticks.write_trades(file_messages(spark, str(landed)), table, f"{table}-bad", checkpoint, available_now=False)
        assert ticks.stop_when_idle(query, 6)
        return read_table(spark, table, schemas.TRADES).count()

    thread = threading.Thread(target=later)
    thread.start()
    assert run() == landings
    thread.join()
    messages(landed, "9.json", [(9, ("B", 9.0, T))])
    assert run() == landings + 1
    assert json.loads((landed / "9.json").read_text())["offset"] == 9
