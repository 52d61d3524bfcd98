"""The checkpoint folder: the cluster's setting wins, and a cluster without one is an error."""

import types

import pytest

from lexitrend.session import ensure_checkpoint_dir


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **conf):
    return types.SimpleNamespace(sparkContext=FakeContext(master),
                                 conf=types.SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_the_clusters_folder_is_used():
    assert ensure_checkpoint_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session(master))


def test_a_local_session_gets_a_scratch_folder():
    assert "lexitrend-ckpt-" in ensure_checkpoint_dir(session("local[2]"))
