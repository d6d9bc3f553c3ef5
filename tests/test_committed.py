import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newstide.sinks import committed
from newstide.sources.streams import table_rows


def lines(spark, path):
    return sorted(r.value for r in committed.read_lines(spark, path).collect())


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    path, frame = str(tmp_path / "p"), spark.range(50).select(F.concat(F.lit("é "), "id").alias("value"))
    assert lines(spark, path) == []
    for _ in range(2):
        committed.write_lines(frame.repartition(5), path, "a")
    committed.write_lines(frame.limit(0), path, "b")
    committed.write_lines(spark.createDataFrame([("x",), (None,), ("",)], "value string"), path, "c")
    assert lines(spark, path) == sorted(["", "x", *(f"é {i}" for i in range(50))])


def test_what_failed_tasks_leave_does_not_count(spark, tmp_path):
    path, switch = str(tmp_path / "p"), tmp_path / "fail"
    switch.touch()

    def risky(batches):
        for n, batch in enumerate(batches):
            if switch.exists() and 7 in batch.column(0).to_pylist():
                raise ValueError("lost")
            yield batch

    frame = spark.range(0, 40, 1, 8).mapInArrow(risky, "id bigint").select(F.col("id").cast("string").alias("value"))
    with pytest.raises(Exception, match="lost"):
        committed.write_lines(frame, path, "a")
    assert lines(spark, path) == []
    switch.unlink()
    committed.write_lines(frame, path, "a")
    assert lines(spark, path) == sorted(map(str, range(40)))


def test_only_the_attempt_that_is_committed_counts(spark, tmp_path):
    own = committed._Lines({"path": str(tmp_path / "p")})
    batch = pa.RecordBatch.from_pydict({"value": ["1", "2"]})
    attempts = [own.attempt(iter([batch]), "a") for _ in range(3)]
    own.publish([attempts[1], None], "a")
    assert lines(spark, str(tmp_path / "p")) == ["1", "2"]
    own.discard([attempts[0], None])
    assert len(list((tmp_path / "p" / "lines").iterdir())) == 2


def test_a_replayed_micro_batch_leaves_no_doubled_lines(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "p", "cp"))
    schema = spark.createDataFrame([], "value string").schema

    def run(*values):
        if values:
            spark.createDataFrame([(v,) for v in values], schema).coalesce(1).write.mode("append").parquet(folder)
        rows = table_rows(spark, folder, schema)
        committed.stream_lines(rows, path, checkpoint).awaitTermination()
        return lines(spark, path)

    assert run("a", "b") == ["a", "b"] and run("c") == ["a", "b", "c"]
    commits = tmp_path / "cp" / "commits"
    last = max(int(p.name) for p in commits.glob("[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink()
    assert run() == ["a", "b", "c"] and run("d") == ["a", "b", "c", "d"]
