import types

import pytest

from topicflow import storage
from topicflow.errors import NoSharedFolder


def session(master, folder=None):
    conf = types.SimpleNamespace(get=lambda name: folder)
    context = types.SimpleNamespace(
        master=master, applicationId=f"app-{master}", getConf=lambda: conf, getCheckpointDir=lambda: None
    )
    return types.SimpleNamespace(sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(NoSharedFolder):
        storage.shared_folder(session(master))
    assert storage.shared_folder(session(master, "hdfs:///shared/")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[4,2]", "local[*]"])
def test_one_process_gets_one_temporary_folder(master):
    one = session(master)
    assert storage.shared_folder(one) == storage.shared_folder(one)
