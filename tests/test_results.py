"""Published versions of result tables, and reads by key from buckets."""

import pytest
from pyspark.sql import functions as F

from depweave.operators import lookup
from depweave.sinks import Results


def partners(spark, n, cnt):
    return spark.range(n).select(
        F.concat(F.lit("d"), F.col("id") % 50).alias("dep1"),
        F.concat(F.lit("e"), "id").alias("dep2"),
        F.lit(cnt).cast("long").alias("cnt"),
        F.floor(F.col("id") / 50).alias("rank"),
    )


def counts(spark, n):
    return spark.createDataFrame([("K", n)], "name string, n long")


def test_a_job_that_fails_leaves_the_former_results(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(ValueError):
        Results(spark, folder, "python").read("counts")
    first = Results(spark, folder, "python")
    first.write("cooccurs", partners(spark, 200, 1))
    first.write("counts", counts(spark, 1))
    assert first.read("counts").first()["n"] == 1
    first.publish()

    killed = Results(spark, folder, "python")
    killed.write("cooccurs", partners(spark, 100, 2))
    fail = counts(spark, 2).withColumn("n", F.raise_error(F.lit("killed")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        killed.write("counts", fail)

    reader = Results(spark, folder, "python")
    assert reader.read("counts").first()["n"] == 1
    assert {(r.cnt, r.n) for r in reader.read("cooccurs").groupBy("cnt").agg(F.count("*").alias("n")).collect()} == {(1, 200)}

    # Tables that a later job doesn't write stay current; the others change together.
    held = reader.read("cooccurs")
    second = Results(spark, folder, "python")
    second.write("cooccurs", partners(spark, 300, 3))
    assert reader.read("cooccurs").count() == 200
    second.publish()
    assert reader.read("cooccurs").count() == 300 and reader.read("counts").first()["n"] == 1
    assert held.count() == 200
    other = Results(spark, folder, "go")
    other.write("counts", counts(spark, 9))
    other.publish()
    second.prune()
    assert reader.read("cooccurs").count() == 300 and other.read("counts").first()["n"] == 9
    left = [p for p in (tmp_path / "out" / "versions").glob("*/cooccurs/lang=*")]
    assert len(left) == 1


def final_plan(table):
    table._jdf.collectToPython()
    return table._jdf.queryExecution().executedPlan().toString()


def test_a_key_reads_one_bucket_and_a_batch_shuffles_no_results(spark, tmp_path):
    results = Results(spark, str(tmp_path / "out"), "python")
    results.write("cooccurs", partners(spark, 5_000, 1))
    results.publish()
    # As a session that has never seen the table: it isn't in the catalog.
    for table in spark.catalog.listTables():
        if table.name.startswith("depweave_python_cooccurs"):
            spark.sql(f"DROP TABLE {table.name}")
    table = Results(spark, str(tmp_path / "out"), "python").read("cooccurs")
    one = lookup.cooccurs_of(table, "d7")
    assert one.count() == 100
    # Spark shows the buckets that a scan selects only where it keeps them apart.
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    try:
        assert "SelectedBucketsCount: 1 out of 16" in final_plan(lookup.cooccurs_of(table, "d7"))
    finally:
        spark.conf.unset(auto)
    keys = spark.range(30).select(F.concat(F.lit("d"), "id").alias("key"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = lookup.cooccurs_of(table, keys)
        text = final_plan(many).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert many.count() == 3_000
    # One exchange: that of the keys.
    assert text.count("Exchange ") == 1 and "Bucketed: true" in text


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    results = Results(spark, str(tmp_path / "out"), "python")
    partners = spark.range(1_000).select(
        F.col("id").cast("string").alias("dep1"), F.lit("x").alias("dep2"), F.lit(1).alias("cnt"), F.lit(0).alias("rank")
    )
    repos = spark.range(70).select(F.lit("u").alias("user"), F.col("id").cast("string").alias("repo_name"))
    for name, table, n in (("cooccurs", partners, 1_000), ("repos", repos, 70), ("flowers", None, 0), ("rejected", None, 0)):
        if table is None:
            # Empty by statistics, and empty only when the plan runs.
            columns = "root string" if name == "flowers" else "file string, record string"
            table = spark.createDataFrame([], columns).unionByName(spark.createDataFrame([], columns).where("1 = 1"))
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        results.write(name, table)
        written = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        assert results.rows(name) == n
        # No job but those of the write.
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == written >= before
    results.publish()
    assert Results(spark, str(tmp_path / "out"), "python").rows("cooccurs") == 1_000
    assert results.read("cooccurs").count() == 1_000
