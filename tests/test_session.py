"""The shared folder, intermediate tables and trainer caches."""

import os

import pytest

from conftest import SF_SMALL
from maskweave import session
from maskweave.catalog.common import docs
from maskweave.operators import merges as M
from maskweave.operators import words as WD


class _Conf:
    def get(self, key, default=None):
        return default

    def set(self, key, value):
        raise AssertionError("no folder may be chosen off local mode")


class _Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session(master))


def test_discard_deletes_the_files(spark):
    df = session.materialize(spark.range(5), "discard-test")
    path = df._maskweave_path.removeprefix("file:")
    assert os.path.isdir(path)
    session.discard(df)
    assert not os.path.exists(path)


def test_trainer_caches_are_released(spark):
    spark.catalog.clearCache()
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size
    before = kept()
    words = WD.wordpiece_words(docs(spark, SF_SMALL))
    M.learn_merges(words, "wordpiece", max_merges=0).release()
    M.learn_merges(words, "wordpiece", max_merges=3).release()
    M.word_vocab(words, 10)
    assert kept() == before
