import pytest

from quern import session as S


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class Context:
    def __init__(self, master):
        self.master, self.made = master, None

    def getCheckpointDir(self):
        return f"file:{self.made}/0b1c" if self.made else None

    def setCheckpointDir(self, path):
        self.made = path


class Session:
    def __init__(self, value, master):
        self.conf, self.sparkContext = Conf(value), Context(master)


def test_the_configured_folder_is_used():
    assert S.shared_dir(Session("hdfs://shared/checkpoints", "yarn")) == "hdfs://shared/checkpoints"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(Session(None, "yarn"))


def test_a_local_session_keeps_one_folder():
    session = Session(None, "local[4]")
    made = S.shared_dir(session)
    assert made.startswith("/tmp/run-") and S.shared_dir(session) == f"file:{made}"


def test_lineage_is_cut_and_rows_kept(spark):
    df = S.cut_lineage(spark.range(10).selectExpr("id", "id * 2 as twice"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert S.new_folder(spark, "a") != S.new_folder(spark, "a")
