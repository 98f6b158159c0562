"""What staging leaves behind."""

import time
from pathlib import Path

from offerlens.staging import drop_stage, stage


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {file for folder in disk.localDirsString() for file in Path(folder).rglob("shuffle_*.data")}


def test_a_staged_write_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    staged = stage(spark.range(10_000).repartition(3, "id").groupBy("id").count(), "shuffled")
    until = time.time() + 5
    while shuffle_files(spark) - before and time.time() < until:  # files are deleted in the background
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert staged.count() == 10_000 and spark.conf.get(name) == setting
    drop_stage(staged)
