import pytest

from eventloom import session
from eventloom.session import fresh_dir, settle, shared_dir


class Unset:
    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "local[2]"

        @staticmethod
        def getCheckpointDir():
            return None


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert shared_dir(Unset) == shared_dir(Unset) == session._temporary_dir()
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_settled_frames_keep_rows_and_types(spark):
    frame = spark.range(10).selectExpr("id", "cast(id as tinyint) t", "if(id > 5, 'x', null) s", "id > 3 b")
    again = settle(frame, "test")
    assert again.dtypes == frame.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, frame.collect()))
    assert settle(frame.where("false"), "test").collect() == []


def test_scratch_folder_must_be_shared_on_a_cluster(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from eventloom import session

    def fake(master, folder=None, named=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))

    assert session.shared_dir(fake("spark://x", named="hdfs://a/")) == "hdfs://a"
    assert session.shared_dir(fake("spark://x", folder="hdfs://b")) == "hdfs://b"
    assert session.shared_dir(fake("local[4]"))
    for master in ("spark://x", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
