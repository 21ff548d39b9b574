"""Shared folder, lineage cuts and the parallelism guard."""

from pyspark.sql import functions as F

from tabulon.session import cut_lineage, spread, shared_path


def test_shared_path_under_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    p = shared_path(spark, "x", unique=True)
    assert p.startswith(root) and p != shared_path(spark, "x", unique=True)


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 100 and cut.agg(F.sum("y")).first()[0] == 9900


def test_spread_has_the_stated_partitions_whatever_the_cores(spark):
    df = spark.range(0, 1000, numPartitions=3)
    out = spread(df, ["id"], 5)
    assert out.rdd.getNumPartitions() == 5 and out.count() == 1000
    again = spread(spark.range(0, 1000, numPartitions=7).orderBy(F.desc("id")), ["id"], 5)
    assert out.rdd.glom().collect() == again.rdd.glom().collect()


def test_build_session_sets_only_what_is_given():
    """A submitted master and partition count stay; checked in a process of its own."""
    import subprocess
    import sys

    code = ("import os; os.environ['PYSPARK_SUBMIT_ARGS'] = '--master local[2] --conf spark.sql.shuffle.partitions=77 "
            "--conf spark.ui.enabled=false pyspark-shell'\n"
            "from tabulon.session import build_session\n"
            "s = build_session(); print('HAS', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert "HAS local[2] 77" in out.stdout, out.stderr[-500:]
