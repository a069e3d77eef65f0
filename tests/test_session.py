"""Session helpers respect cluster-provided settings."""

import pytest

from pubspark.session import ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    used = ensure_checkpoint_dir(spark)
    assert configured and configured.rstrip("/").split(":")[-1] in used


def test_split_hint_set_for_the_parse(spark):
    assert int(spark.conf.get("spark.sql.files.minPartitionNum")) >= spark.sparkContext.defaultParallelism


def test_unset_checkpoint_dir_raises_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
