from types import SimpleNamespace

import pytest

from firmlens.session import scratch_path, shared_root, stored


def _session(folder, master, application="app-1"):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=application))


def test_cluster_folder_wins():
    assert shared_root(_session("hdfs://x/ck/", "yarn")) == "hdfs://x/ck"
    assert scratch_path(_session("/ck", "local[2]"), "a").startswith("/ck/a-")


def test_local_fallback_only_for_local_masters():
    local = _session(None, "local[2]", "app-2")
    assert shared_root(local) == shared_root(local)
    with pytest.raises(ValueError):
        shared_root(_session(None, "spark://host:7077"))


def test_stored_reads_back_the_same_rows(spark):
    df = spark.range(5).selectExpr("id", "id * 0.5 AS half")
    out = stored(df)
    assert out.schema.names == df.schema.names and sorted(out.collect()) == sorted(df.collect())
