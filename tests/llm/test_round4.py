"""Faults that the review of round 4 found, a test each."""

from corpuskit.llm import simhash


def test_visitors_are_never_broadcast(spark, tmp_path):
    """Spark sized the visits, 68 a fingerprint, as the fingerprints, under its default limit, and sent all of them to the driver."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    spark.range(3000).selectExpr("id * 3 as fp").write.parquet(f"{tmp_path}/fps")
    links = simhash.link_fingerprints(spark.read.parquet(f"{tmp_path}/fps"), 2, 2)
    found = links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan, plan
    assert len(found) == len(set(found)) > 0 and all((r["a"] ^ r["b"]).bit_count() <= 2 for r in found)
