from types import SimpleNamespace

import pytest

from tickloom import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, conf=None, folder=None):
    settings = {session.CHECKPOINT_DIR: conf} if conf else {}
    return SimpleNamespace(sparkContext=Context(master, folder), conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("yarn", conf="hdfs://n/c/")) == "hdfs://n/c"
    assert session.shared_folder(fake("yarn", folder="hdfs://n/set")) == "hdfs://n/set"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))


def test_a_local_session_gets_one_temporary_folder():
    local = fake("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_work_folders_are_fresh_and_lie_below_the_shared_folder(spark):
    one, other = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert one != other and one.startswith(session.shared_folder(spark) + "/tickloom/x-")


def test_stored_reads_back_what_was_written(spark):
    rows = spark.range(5).selectExpr("id", "cast(id as decimal(18,2)) price")
    again = session.stored(rows, "t")
    assert again.schema.simpleString() == rows.schema.simpleString()
    assert sorted(again.collect()) == sorted(rows.collect())
