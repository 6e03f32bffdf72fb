"""The shared folder and the scratch tables in it."""

from types import SimpleNamespace

import pytest

from tradewind import session


def stub(master, named=None, folder=None):
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: named), getCheckpointDir=lambda: folder, setCheckpointDir=lambda path: None, applicationId="stub")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(stub(master))
    assert session.shared_folder(stub(master, "hdfs://x/shared")) == "hdfs://x/shared"


def test_one_machine_may_do_without():
    assert "tradewind-checkpoint-" in session.shared_folder(stub("local[4]"))


def test_scratch_tables_are_deleted_when_told(spark, tmp_path):
    before = set(session.stages(spark))
    kept, gone = session.staged(spark.range(3), "kept"), session.staged(spark.range(4), "gone")
    mine = [p for p in session.stages(spark) if p not in before]
    assert session.drop_stages(spark, mine[1:]) == 1 and set(session.stages(spark)) == before | {mine[0]}
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.count()
