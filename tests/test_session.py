"""Where intermediate tables go."""

import os

import pytest

from tenderlake import session


class Fake:
    """A session as far as ensure_checkpoint_dir looks at it."""

    def __init__(self, master, conf_dir=None):
        self.master, self.conf_dir, self.dir = master, conf_dir, None
        self.sparkContext = self
        self.conf = self

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.conf_dir or default


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_local_masters_get_a_folder_of_their_own(master):
    assert os.path.isdir(session.ensure_checkpoint_dir(Fake(master)))


@pytest.mark.parametrize("master", ["local-cluster[3,2,1000]", "yarn", "spark://h:7077", "k8s://h"])
def test_clusters_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="shared folder"):
        session.ensure_checkpoint_dir(Fake(master))
    assert session.ensure_checkpoint_dir(Fake(master, "hdfs://nn/ckpt")) == "hdfs://nn/ckpt"


def test_clear_scratch(spark):
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    keep = spark.sparkContext.getCheckpointDir()
    session.clear_scratch(spark)
    assert spark.sparkContext.getCheckpointDir() == keep
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
