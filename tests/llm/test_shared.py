import pytest

from ledgerloom.llm import shared


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_shared_folder_is_the_session_s_and_local_only_on_a_local_master():
    assert shared.shared_folder(Session(spark_checkpoint_dir="hdfs://a/b/", spark_master="yarn")) == "hdfs://a/b"
    local = shared.shared_folder(Session(spark_master="local[2]"))
    assert local == shared.shared_folder(Session(spark_master="local[2]"))
    with pytest.raises(ValueError):
        shared.shared_folder(Session(spark_master="spark://host"))


def test_fresh_names_clash_with_no_column(spark):
    df = spark.createDataFrame([(1, 2)], "made int, MADE_ int")
    assert shared.fresh(df, "made", "other") == ["made__", "other"]
    assert shared.fresh(df, "x", "x") == ["x", "x_"]
