"""The shared folder for intermediate tables."""

from __future__ import annotations

import pytest

from tripflow import session


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, conf, None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf({"spark.sql.warehouse.dir": "file:/w", **conf})
        self.sparkContext = _Context(master, self.conf)


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://h:7077", "k8s://x", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(_Session(master))
        assert session.checkpoint_dir(_Session(master, **{"spark.checkpoint.dir": "hdfs:/shared"})) == "hdfs:/shared"


def test_a_local_session_gets_a_folder_beside_its_warehouse():
    for master in ("local", "local[8]", "local[*]"):
        assert session.checkpoint_dir(_Session(master)) == "file:/w/_tripflow_scratch"
