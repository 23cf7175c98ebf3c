"""What is kept in the shared folder, and for how long."""

import os

import pytest

from matchcast import queries, shared


def files(folder):
    return {f"{d}/{n}" for d, _, names in os.walk(folder.removeprefix("file:")) for n in names}


def test_a_block_leaves_nothing(spark, sf):
    folder = spark.conf.get("spark.checkpoint.dir")
    with shared.scratch(spark):
        shared.cut(spark.range(10))
    before = files(folder)
    for name in ("q01_csv_round_trip", "q14_ordered_holdout", "q43_target_statistics"):
        with shared.scratch(spark):
            assert queries.queries()[name](spark, sf).count() > 0 and files(folder) - before
        assert files(folder) <= before  # Spark's cleaner may take older ones meanwhile


def test_frames_are_whole_until_then(spark):
    with shared.scratch(spark):
        kept = shared.cut(spark.range(100))
        with shared.scratch(spark):
            inner = shared.cut(kept.where("id < 10"))
            assert inner.count() == 10
        assert kept.count() == 100


def test_the_setting_of_others_stays(spark):
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get(shared._CLEANS, "false")
    shared.cut(spark.range(1))
    assert conf.get(shared._CLEANS, "false") == before


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared.shared_dir(Session())
