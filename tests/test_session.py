"""The shared folder where the session names none."""

import os

import pytest

from claimlake.session import shared_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        raise AssertionError("a running session's settings stay as they are")


class _Session:
    def __init__(self, master, app):
        self.conf = _Conf({"spark.master": master, "spark.app.id": app})


def test_local_session_without_a_checkpoint_folder():
    first, second = _Session("local[2]", "app-1"), _Session("local[2]", "app-2")
    assert os.path.isdir(shared_dir(first)) and shared_dir(first) == shared_dir(first)
    assert shared_dir(first) != shared_dir(second)
    assert shared_dir(first, "x") == os.path.join(shared_dir(first), "x")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_session_must_name_one(master):
    with pytest.raises(ValueError):
        shared_dir(_Session(master, "app-3"))
