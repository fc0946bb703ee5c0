"""Folders of many small files: one folder for each file and a listing job for each folder took 10 ms a page."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuskit.plans import files as plans
from corpuskit.sources import files, folders


def jobs_tasks(spark, make):
    """What ``make`` returns, and the number of tasks it ran."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    try:
        made = make()
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds]
        return made, sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i)
    finally:
        sc.setJobGroup("", "")


def test_text_files_of_long_ids(spark, tmp_path):
    """Ids were cut to six digits, so pages shared a file; repeated ids and a page without one keep a row each."""
    ids = [0, 7, 7, 123456, 1234567, 12345678, -5, None]
    spark.createDataFrame([(n, f"http://a/{i}") for i, n in enumerate(ids)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = plans.text_files(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter((n, f"first line|http://a/{i}") for i, n in enumerate(ids))


def test_attached_files_are_not_a_task_each(spark, tmp_path):
    spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit(" http://a/"), "id").alias("url")).write.parquet(f"{tmp_path}/pages.parquet")
    got, tasks = jobs_tasks(spark, lambda: plans.attachments(spark, str(tmp_path)).collect())
    assert sorted(map(tuple, got)) == sorted((f"http://a/{i}", True) for i in range(300)) and tasks < 150, tasks


def test_block_files_are_not_a_task_each(spark, tmp_path):
    rows = [*((i, f"http://a/{i}") for i in range(300)), (7, "again"), (None, "no id")]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got, tasks = jobs_tasks(spark, lambda: plans.block_files(spark, str(tmp_path)).collect())
    want = [r for i, u in rows if i is not None and i % 10 not in (3, 4) for r in ((f"p{i}", 0, 0, u, None), (f"p{i}", 1, 1, "end\nof page", None))]
    want += [(None, None, None, None, f"[FAIL] p{i}: unreadable" if i % 10 == 3 else f"[WARN] p{i}: no text extracted") for i in range(300) if i % 10 in (3, 4)]
    want += [(None, None, None, None, a) for a in ("[FAIL] none: 0 bytes", "[WARN] missing folder: st1")]
    assert Counter(map(tuple, got)) == Counter(want) and tasks < 200, tasks


@pytest.mark.parametrize("glob", ["*.txt", "*.{txt,md}", "?.[mt]*"])
def test_files_are_those_that_spark_reads(spark, tmp_path, glob):
    names = ["a.txt", "b.md", "c.bin", ".hidden.txt", "_gone.txt", "ü ä+%.txt", "k=v/d.txt", "deep/e.txt", "deep/_no/f.txt", "x._COPYING_"]
    for name in names:
        os.makedirs(os.path.dirname(tmp_path / "in 1" / name), exist_ok=True)
        (tmp_path / "in 1" / name).write_bytes(name.encode())
    for folder, deep in ((f"{tmp_path}/in 1", True), (f"file://{tmp_path}/in*/d{{eep,ip}}", False), (f"{tmp_path}/in ?/a.txt", False)):
        want = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", deep).load(folder).select("path", "length", "content")
        assert sorted(map(tuple, folders.open_files(spark, folder, glob, deep).collect())) == sorted(map(tuple, want.collect()))
    texts = spark.read.text(f"{tmp_path}/in 1/[aü]*", wholetext=True, pathGlobFilter="*.txt").select(F.input_file_name(), "value")
    assert sorted(map(tuple, files.read_texts(spark, f"{tmp_path}/in 1/[aü]*").select("path", "raw").collect())) == sorted(map(tuple, texts.collect()))


def test_other_stores_and_missing_folders_are_left_to_spark(spark, tmp_path):
    assert folders.open_files(spark, f"{tmp_path}/none", "*.txt") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_texts(spark, f"{tmp_path}/none").collect()


def test_names_of_both_forms(spark):
    rows = [("file:/x/3f/p12.txt", "p12"), ("file:/x/name=p12/part-0-c000.txt", "p12"), ("file:/x/3f-1/p 1.txt", "p 1")]
    assert [r["n"] for r in spark.createDataFrame(rows, "p string, w string").select(folders.name_of(F.col("p")).alias("n")).collect()] == [w for _, w in rows]
