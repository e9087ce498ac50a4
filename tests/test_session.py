"""The shared folder and what stays behind a stored table."""

from pyspark.sql import functions as F

from homegrid.session import CLEANUP, shuffles_dropped, stored_copy


def test_a_stored_copy_leaves_no_shuffle_behind(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return blocks.getAllFiles().mkString("|").count("shuffle_")

    df = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.max("id").alias("m"))
    before = shuffles()
    copy = stored_copy(df, "test")
    assert shuffles() == before
    assert copy.count() == df.count() == 1000 and copy.agg(F.sum("m")).first()[0] == df.agg(F.sum("m")).first()[0]


def test_the_setting_comes_back(spark):
    before = spark.conf.get(CLEANUP)
    try:
        with shuffles_dropped(spark):
            assert spark.conf.get(CLEANUP) == "true"
            raise ValueError
    except ValueError:
        assert spark.conf.get(CLEANUP) == before
