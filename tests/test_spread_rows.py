"""Rows of a file with one row group meet in one task however many splits the file has."""

from pyspark.sql import functions as F

from tessera.operators import lsh


def test_one_row_group_is_shingled_by_all_tasks(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(i))) for i in range(8)]).alias("text")).coalesce(1).write.parquet(path)
    target, key = spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(20_000))
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() >= target
        sizes = [r["n"] for r in lsh.shingle(docs).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / target
        assert lsh.shingle(docs.where("doc_id < 0")).count() == 0
    finally:
        spark.conf.set(key, old)
