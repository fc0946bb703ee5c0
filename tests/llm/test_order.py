"""The order of the mix in the packed sequences."""

import random

import corpus_pipeline


def test_sequences_follow_the_written_mix(spark, tmp_path):
    rng = random.Random(13)
    # Files of growing size: Spark reads the largest first.
    rows = [(i, " ".join(rng.choices(("ab", "cd", "ef"), k=20 + i // 3)), i // 500) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, part int").repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id")
    table.write.parquet(f"{tmp_path}/mix")
    first = {}
    for r in corpus_pipeline.pack(spark, spark.read.parquet(f"{tmp_path}/mix"), "").collect():
        first.setdefault(r["sequence_id"], []).append(r["doc_id"])
    seen, worst = -1, 0
    for s in sorted(first):
        worst = max(worst, seen - min(first[s]))
        seen = max(seen, *first[s])
    # The differencing deals among 384 documents, and a window can wait for the next group.
    assert {i for ids in first.values() for i in ids} == set(range(3000)) and worst <= 2 * 384
