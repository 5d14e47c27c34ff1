from types import SimpleNamespace

import pytest

from candlewright.session import checkpointed, shared_folder


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master))


def test_only_local_masters_do_without_a_shared_folder():
    assert shared_folder(session("local[4]")) == shared_folder(session("local"))
    assert shared_folder(session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_checkpointed_rows_are_read_back(spark):
    kept = checkpointed(spark.range(5))
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3, 4] and "Range" not in kept._jdf.queryExecution().executedPlan().toString()
