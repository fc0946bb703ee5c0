"""Commits that survive a kill, vectors in files, broken files, and streams that wait."""

import os
import signal
import subprocess
import sys
import textwrap
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.sources import files, npy
from corpuskit.sources.ledger import Ledger
from corpuskit.streaming import sensor

ROOT = str(Path(__file__).parents[1])
ROWS = "doc_id bigint, x string"


def test_a_killed_run_loses_and_repeats_nothing(spark, tmp_path):
    """Another process is killed while it writes its third chunk; this one resumes."""
    path, mark = str(tmp_path / "ledger"), tmp_path / "third"
    script = f"""
        import sys, time
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession, functions as F
        from corpuskit.sources.ledger import Ledger
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "marks")!r}).getOrCreate()
        ledger, calls = Ledger(spark, {path!r}, {ROWS!r}), []

        def make(part):
            calls.append(1)
            def slow(batches):
                for b in batches:
                    if len(calls) == 3:
                        open({str(mark)!r}, "a").write("x")
                        yield b
                        time.sleep(60)
                    else:
                        yield b
            return part.mapInPandas(slow, {ROWS!r})

        todo = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("first").alias("x"))
        ledger.resume(todo, "doc_id", make, chunks=5)
    """
    run = subprocess.Popen([sys.executable, "-c", textwrap.dedent(script)], start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    end = time.time() + 120
    while not mark.exists() and run.poll() is None and time.time() < end:
        time.sleep(0.2)
    time.sleep(1)
    os.killpg(run.pid, signal.SIGKILL)
    run.wait()
    ledger = Ledger(spark, path, ROWS)
    before = ledger.read().count()
    assert len(ledger.commits()) == 2 and 0 < before < 400
    todo = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("second").alias("x"))
    assert ledger.resume(todo, "doc_id", lambda part: part, chunks=5) == 3
    rows = ledger.read().collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(400))
    assert sum(r["x"] == "first" for r in rows) == before
    assert ledger.sweep() == 1 and ledger.read().count() == 400 and ledger.sweep() == 0


def test_a_batch_counts_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"), ROWS)
    assert ledger.read().count() == 0 and ledger.commits() == []
    rows = spark.createDataFrame([(1, "a"), (2, None)], ROWS)
    assert ledger.append(rows, "one") and not ledger.append(rows, "one")
    assert ledger.append(rows.where("false"), "none")
    # Two that both saw no commit: the second rename fails.
    assert not ledger._commit("one", "{}")
    assert sorted(ledger.read().collect()) == sorted(rows.collect()) and [c["n"] for c in ledger.commits()] == [0, 2]
    with pytest.raises(ValueError):
        ledger.append(rows, "a/b")


def test_keys_once_over_runs(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"), ROWS)
    one = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, None)], ROWS)
    ledger.append_new(one, "x", ["doc_id"])
    ledger.append_new(one.union(spark.createDataFrame([(0, "a"), (9, "c")], ROWS)), "x", ["doc_id"])
    ledger.append_new(one, "x", ["doc_id"])
    assert sorted(map(tuple, ledger.read().collect())) == [(1, "a"), (2, "b"), (9, "c")]


@pytest.mark.parametrize("kind", ["<f4", ">f4", "<f8", ">f8", "<i2", "|u1"])
@pytest.mark.parametrize("order", ["C", "F"])
def test_npy_as_numpy_reads_it(spark, tmp_path, kind, order):
    made = np.asarray(np.random.default_rng(0).integers(0, 200, (1003, 7)) / (1 if kind[1] in "iu" else 8), kind)
    path = tmp_path / "v.npy"
    np.save(path, np.asfortranarray(made) if order == "F" else made)
    df = npy.read_npy(spark, str(path), "float", bytes_per_task=7 * 100 * made.itemsize)
    assert df.rdd.getNumPartitions() == 11  # one file, many tasks
    got = df.orderBy("row").collect()
    assert [r["row"] for r in got] == list(range(1003)) and np.array_equal([r["vector"] for r in got], made.astype(np.float32))


def test_npy_folders_lists_and_bad_files(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(5.0))
    np.save(tmp_path / "b.npy", np.zeros((0, 1)))
    np.save(tmp_path / "c.npy", np.arange(3.0))
    (tmp_path / "d.txt").write_text("no")
    got = npy.read_npy(spark, str(tmp_path)).orderBy("row").collect()
    assert [(r["row"], r["vector"]) for r in got] == [(i, [v]) for i, v in enumerate([0.0, 1, 2, 3, 4, 0, 1, 2])]
    assert npy.read_npy(spark, str(tmp_path), vectors=False).count() == 8
    (tmp_path / "e.npy").write_bytes(b"none of this")
    with pytest.raises(Exception, match="not an .npy file"):
        npy.read_npy(spark, str(tmp_path)).count()


def test_npy_is_written_once(spark, tmp_path):
    path, calls = str(tmp_path / "kept"), []

    def make():
        calls.append(1)
        return spark.range(50, numPartitions=4).select(F.array(F.col("id").cast("float"), F.lit(0.5).cast("float")).alias("vector"))

    for _ in range(2):
        got = npy.read_or_compute_npy(spark, path, make, "float").orderBy("row").collect()
        assert [r["vector"] for r in got] == [[float(i), 0.5] for i in range(50)]
    assert len(calls) == 1 and sorted(os.listdir(path)) == [f"part-0000{i}.npy" for i in range(4)]
    assert np.load(f"{path}/part-00000.npy").dtype == np.float32
    with pytest.raises(Exception, match="one length"):
        npy.write_npy(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "vector array<double>").coalesce(1), str(tmp_path / "bad"))
    assert [n for n in os.listdir(tmp_path / "bad") if n.endswith(".npy")] == []


def test_broken_files_are_rows_of_the_audit(spark, tmp_path):
    folder = tmp_path / "st 4+"
    folder.mkdir()
    for name, body in {
        "good.json": '{"pages": [{"blocks": [{"type": 0, "text": "one"}, {"type": 1, "text": "no"}, {"type": 0, "text": "two"}]}, {"blocks": null}, null]}',
        "empty.json": "", "cut.json": '{"pages": [{"bl', "none.json": '{"pages": []}', "blank.json": '{"pages": [{"blocks": [{"type": 0, "text": " "}, {"type": null, "text": "x"}]}]}', "list.json": "[1, 2]", "bytes.json": "\udcff\udcfe",
    }.items():
        (folder / name).write_bytes(body.encode("utf-8", "surrogateescape"))
    read = files.read_block_files(spark, str(tmp_path))
    got = {(r["doc"].removeprefix("st 4+/"), r["page"], r["block_no"], r["text"], (r["audit"] or "").rpartition(": ")[2]) for r in read.collect()}
    assert got == {
        ("good.json", 0, 0, "one", ""), ("good.json", 0, 2, "two", ""), ("empty.json", None, None, None, "0 bytes"), ("cut.json", None, None, None, "unreadable"),
        ("none.json", None, None, None, "no text extracted"), ("blank.json", None, None, None, "no text extracted"), ("list.json", None, None, None, "unreadable"), ("bytes.json", None, None, None, "unreadable"),
    }
    lines = [r["audit"] for r in files.audit_lines(spark, read, str(tmp_path), ["st 4+", "st6"]).collect()]
    assert len(lines) == 7 and lines == sorted(lines) and "[WARN] missing folder: st6" in lines


def test_sensor_reports_arrival_and_timeout_once(spark, tmp_path):
    folder, wishes, out = (tmp_path / n for n in ("in", "wishes", "out"))
    for p in (folder, wishes):
        p.mkdir()
    (folder / "early").write_text("x")  # before its wish
    query = sensor.start_sensor(spark, str(wishes), str(folder), str(out), str(tmp_path / "marks"), poll=0.3)
    read = lambda: {r["name"]: (r["outcome"], r["waited"]) for r in spark.read.schema(sensor.OUTCOME).parquet(str(out)).collect()}

    def until(n):
        end = time.time() + 90
        while time.time() < end:
            assert query.exception() is None
            if os.path.isdir(out / "_spark_metadata") and len(read()) >= n:
                return
            time.sleep(0.3)

    def put(path, text):  # written aside and moved, as a stream may look at any time
        (tmp_path / "aside").write_text(text)
        os.rename(tmp_path / "aside", path)

    try:
        put(wishes / "w1.json", '{"name": "early", "seconds": 60}\n{"name": "late", "seconds": 60}\n{"name": "never", "seconds": 2}\n{"name": "never", "seconds": 3}\n')
        until(2)
        found = read()
        assert found["early"] == ("arrived", 0.0) and found["never"][0] == "timeout" and found["never"][1] >= 2 and "late" not in found
        put(folder / "late", "x")
        until(3)
        put(folder / "never", "x")  # too late, and no second outcome
        time.sleep(5)
        assert {n: o for n, (o, _) in read().items()} == {"early": "arrived", "late": "arrived", "never": "timeout"}
        assert spark.read.schema(sensor.OUTCOME).parquet(str(out)).count() == 3
    finally:
        query.stop()


def test_waiting_for_files_ends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("x")
    names = spark.createDataFrame([("a.json",), ("a.json",), ("b.json",), (None,)], "name string")
    got = sensor.wait_for_files(spark, names, str(tmp_path / "in"), str(tmp_path / "root"), poll=0.5, limit=2.0)
    assert sorted((r["name"], r["outcome"]) for r in got.collect()) == [("a.json", "arrived"), ("b.json", "timeout")]
    none = sensor.wait_for_files(spark, names.where("name is null"), str(tmp_path / "in"), str(tmp_path / "root2"), poll=0.5, limit=1.0)
    assert none.count() == 0
