from types import SimpleNamespace

import pytest

from riskloom.session import checkpoint_folder


def session(master, folder=None):
    chosen = []
    context = SimpleNamespace(
        master=master,
        setCheckpointDir=chosen.append,
        getCheckpointDir=lambda: chosen[-1] if chosen else None,
    )
    conf = SimpleNamespace(get=lambda name, default=None: folder or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    assert checkpoint_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="shared"):
        checkpoint_folder(session("yarn"))


def test_one_machine_may_use_a_temporary_folder():
    assert "riskloom-checkpoint-" in checkpoint_folder(session("local[2]"))
