"""Shared storage: a cluster without a shared checkpoint folder is refused."""

import pytest

from netscope import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session(master), "x")


def test_derived_folders_are_new_each_time(spark):
    a, b = session.unique_subdir(spark, "x"), session.unique_subdir(spark, "x")
    assert a != b
