import pytest
from pyspark.sql import functions as F

from flowloom.operators import audit, sampling
from flowloom.plans import jobs
from flowloom.sources import tables


def test_readers_see_whole_tables_only(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    tables.commit(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"])
    bad = spark.range(100).repartition(8).withColumn("k", F.when(F.col("id") == 77, F.raise_error(F.lit("killed"))).otherwise(0).cast("long"))
    with pytest.raises(Exception, match="killed"):  # some parts were written, nothing was committed
        tables.commit(bad, path, ["k"])
    assert tables.read_table(spark, path).count() == 10
    first = tables.versions(spark, path).first().committed
    tables.commit(spark.range(10, 15).withColumn("k", F.lit(0).cast("long")), path, ["k"], add=True)
    assert tables.read_table(spark, path).count() == 15
    old = tables.read_table(spark, path)
    tables.commit(spark.range(3).withColumn("k", F.lit(1).cast("long")), path, ["k"])
    assert tables.read_table(spark, path).count() == 3 and old.count() == 15
    assert tables.read_table(spark, path, as_of=first).count() == 10
    plan = tables.read_table(spark, path).where("k = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_samples_beyond_the_broadcast_threshold_are_the_same(spark):
    """A file with nine tenths of the rows is dealt over many parts where its cut table isn't broadcast."""
    rows = spark.range(4000).select(
        F.concat(F.lit("k"), "id").alias("row_key"), F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 70)).alias("file"))
    targets = rows.groupBy("file").agg(F.count("*").alias("total_rows")).withColumn("want", F.floor(F.col("total_rows") / 3))
    usual = sampling.take_exact(rows, targets, ["file"], range_rows=64).collect()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        dealt = sampling.take_exact(rows, targets, ["file"], range_rows=64)
        assert "_part" in dealt._jdf.queryExecution().optimizedPlan().toString()
        parts = dealt.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, usual)) == sorted(map(tuple, parts)) and len(parts) == sum(r.want for r in targets.collect())
    assert [sampling._bytes(x) for x in ("-1", "10485760b", "10MB", " 2 g ")] == [-1, 10485760, 10485760, 2 << 30]


def test_an_audit_reads_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    made = [(f"f{i % 6}", ["train", "val", "test"][i % 3], "Benign" if i % 2 else "DoS", i % 2 ^ 1, float(i) if i % 9 else None) for i in range(90)]
    spark.createDataFrame(made, "source_relative_file string, split string, source_class_folder string, target_binary int, x double").write.parquet(path)
    rows = spark.read.parquet(path)
    facts = audit.split_facts(rows, ["x"])
    assert facts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    checks = jobs.audit_split(rows, ["x"], ["DoS"])
    assert "/rows]" not in checks._jdf.queryExecution().executedPlan().toString()
    got = {r.check: (r.status, r.detail) for r in checks.collect()}
    assert got["no NaN in train"] == ("FAIL", "10") and got["no Inf in val"] == ("PASS", "0")
    assert got["DoS absent from val"][0] == "FAIL" and got["no file overlap train-val"] == ("PASS", "0")
