"""Readers, writers and streams on files."""

import json

import pytest
from pyspark.sql import functions as F

from textquarry.sources import readers, writers
from textquarry.sources.zst import write_jsonl_zst
from textquarry.streaming.documents import (
    KEYED_STATE,
    StopAtLimit,
    run_to_parquet,
    stream_dedup,
    stream_documents,
    stream_merge_chunks,
)


def test_broken_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "x"}\n{"id": "2", "te\n{"id": "3"}\n')
    df = readers.read_jsonl(spark, str(tmp_path), "id string, text string, _corrupt_record string", "*.jsonl")
    rows = df.select("id", "text", "_corrupt_record").collect()
    assert sum(r._corrupt_record is not None for r in rows) == 1
    assert [r.text for r in rows if r.id == "3"] == [None]


def test_markdown_table(spark, tmp_path):
    (tmp_path / "t.md").write_text("text\n| Subset | Words |\n|---|--:|\n| `fra_Latn` | 1,234 |\n| `eng` | 5 |\n")
    got = readers.read_markdown_table(spark, str(tmp_path), [("Subset", "string"), ("Words", "bigint")]).collect()
    assert sorted(map(tuple, got)) == [("eng", 5), ("fra_Latn", 1234)]


def test_logs(spark, tmp_path):
    line = "[INFO 2025-03-04 05:06:07] iteration {}/100 | x | train_step_timing in s: {}\n"
    (tmp_path / "log.out").write_text("start\n" + "".join(line.format(i, 1.5 * i) for i in range(3)))
    got = readers.read_run_logs(spark, str(tmp_path)).orderBy("iteration").collect()
    assert [(r.iteration, r.step_seconds) for r in got] == [(0, 0.0), (1, 1.5), (2, 3.0)]


def test_eval_files_keep_time_and_skip_deprecated(spark, tmp_path):
    body = {"results": {"t|0": {"acc": 0.5, "acc_stderr": 0.1}}, "config_general": {"max_samples": None}}
    for folder in ("new", "deprecated"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "results_2025-01-02T03-04-05.123456.json").write_text(json.dumps(body))
    got = readers.read_eval_results(spark, str(tmp_path)).collect()
    assert len(got) == 2 and {r.max_samples for r in got} == {"None"} and got[0].timestamp.microsecond == 123456


def test_partitioned_sink_splits_hot_values(spark, tmp_path):
    ids = spark.range(0, 40_000, 1, 24)
    df = ids.select("id", F.when(F.col("id") < 39_900, "hot").otherwise("cold").alias("lang"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "8k")
    writers.write_jsonl(df, str(tmp_path / "o"), ("lang",))
    spark.conf.unset(size)
    hot = list((tmp_path / "o" / "lang=hot").glob("*.json.gz"))
    assert len(hot) > 8 and len(list((tmp_path / "o" / "lang=cold").glob("*.json.gz"))) == 1
    assert spark.read.json(str(tmp_path / "o")).count() == 40_000


def test_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from textquarry.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    lost = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(lost)


HOUR = "2025-01-01 {:02d}:00:00"


def test_zst_lines_of_many_frames(spark, tmp_path):
    import zstandard

    # One frame a line, as appending writers leave them, and a text far longer than a block.
    lines = [json.dumps({"id": str(i), "text": f"é{i} " * (1 + i % 3)}) for i in range(200)]
    (tmp_path / "a.jsonl.zst").write_bytes(b"".join(zstandard.compress(f"{x}\n".encode()) for x in lines))
    long = json.dumps({"id": "long", "text": "word " * 400_000})
    (tmp_path / "b.jsonl.zst").write_bytes(zstandard.compress(f"{long}\n{{broken\n".encode()))
    df = readers.read_jsonl(spark, str(tmp_path), "id string, text string, _corrupt_record string", "*.jsonl.zst")
    rows = {r.id: r.n for r in df.select("id", F.length("text").alias("n")).collect()}
    assert len(rows) == 202 and rows["long"] == 2_000_000 and rows["7"] == 6
    assert spark.read.schema("id string").json(str(tmp_path / "b.jsonl.zst")).count() == 2


def test_zst_files_round_trip(spark, tmp_path):
    df = spark.range(0, 5000, 1, 3).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 7 > 0, F.repeat(F.lit("text \n\"é"), 20)).alias("text")
    )
    path = str(tmp_path / "out")
    for _ in range(2):  # the second takes the place of the first
        write_jsonl_zst(df, path)
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert len(files) == 3 and all(f.endswith(".jsonl.zst") for f in files)
    back = readers.read_jsonl(spark, path, "id string, text string", "*.zst")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    write_jsonl_zst(df.limit(0), path)
    assert readers.read_jsonl(spark, path, "id string, text string", "*.zst").count() == 0


@pytest.fixture
def arriving(spark, tmp_path):
    """Writes rows and runs a stream over what is new; gives all results and the run's progress."""
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))

    def arrive(rows, schema, stream, **settings):
        spark.createDataFrame(rows, "at string, " + schema).withColumn("arrived_at", F.col("at").cast("timestamp")).drop(
            "at"
        ).write.mode("append").parquet(source)
        df = stream(stream_documents(spark, source, schema + ", arrived_at timestamp", "parquet"))
        progress = run_to_parquet(df, out, mark, **settings)
        return sorted(map(tuple, spark.read.schema(df.schema).parquet(out).collect())), progress

    return arrive


def test_stream_merges_across_runs(arriving):
    schema = "id string, text string, chunk_id int, num_chunks int, finish_reason string"

    def arrive(hour, *rows):
        rows = [(HOUR.format(hour), *r) for r in rows]
        return arriving(rows, schema, lambda df: stream_merge_chunks(df, late="1 hour", patience_ms=7_200_000), **KEYED_STATE)

    first, progress = arrive(0, ("a", "two", 1, 2, "stop"), ("b", "x", 0, 1, "length"), ("c", "z", 0, 2, "stop"))
    assert first == [("b", "x", "rejected")]
    # The same chunk again counts once.
    again, progress = arrive(1, ("a", "one", 0, 2, "stop"), ("c", "z", 0, 2, "stop"), ("d", "late", 2, 3, "stop"))
    merged = [("a", "one\n\ntwo", "merged"), ("b", "x", "rejected")]
    assert again == merged
    # c and d wait until the watermark, an hour behind the clock, is two hours past their last chunk.
    assert arrive(3, ("clock", "", -1, -1, ""))[0] == merged
    without_c = sorted([*merged, ("c", "z", "incomplete")])
    assert arrive(5, ("d", "more", 0, 3, "stop"), ("clock", "", -1, -1, ""))[0] == without_c
    assert arrive(6, ("clock", "", -1, -1, ""))[0] == without_c
    left, progress = arrive(12, ("clock", "", -1, -1, ""))
    assert left == sorted([*without_c, ("d", "more\n\nlate", "incomplete")])
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_stream_forgets_old_contents(arriving):
    def arrive(hour, *texts):
        rows = [(HOUR.format(hour), t, hour) for t in texts]
        found, progress = arriving(
            rows, "text string, hour int", lambda df: stream_dedup(df, F.col("text"), "arrived_at", "2 hours").select("hour", F.coalesce("text", F.lit("")))
        )
        return found, progress[-1]["stateOperators"][0]["numRowsTotal"]

    found, kept = arrive(0, "a b", " a  b ", "c", None)
    assert len(found) == kept == 3 and {"", "c"} < {x[1] for x in found}
    found, kept = arrive(1, "a b", "d")
    assert [x for x in found if x[0] == 1] == [(1, "d")] and kept == 4
    arrive(8, "clock")
    found, kept = arrive(9, "tick")
    assert kept <= 2  # the contents of the first hours are forgotten
    found, kept = arrive(10, "a b", "tick")
    assert [x for x in found if x[0] == 10] == [(10, "a b")]


def test_a_stream_stops_itself_at_the_limit(spark, tmp_path):
    slow = F.when(F.col("value") >= 60, F.lit(9.5)).otherwise(F.lit(1.0))
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 20).load().withColumn("step_seconds", slow)
    stop = StopAtLimit(spark, limit=5.0)
    spark.streams.addListener(stop)
    try:
        query = StopAtLimit.watched(rate).writeStream.format("noop").option("checkpointLocation", str(tmp_path)).start()
        calm = StopAtLimit.watched(rate.withColumn("step_seconds", F.lit(1.0))).writeStream.format("noop").start()
        assert query.awaitTermination(60)
        assert query.exception() is None and calm.isActive
        assert stop.stopped == {str(query.runId): 9.5}
    finally:
        spark.streams.removeListener(stop)
        for q in spark.streams.active:
            q.stop()
