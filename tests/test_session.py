"""Where shared tables go."""

from types import SimpleNamespace

import pytest

from dockcast.session import shared_dir


def session(master, path=None):
    conf = SimpleNamespace(get=lambda key, default=None: path or default)
    context = SimpleNamespace(master=master, applicationId="app-1", getConf=lambda: SimpleNamespace(get=lambda key: None))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_configured_folder_wins():
    assert shared_dir(session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"


def test_only_a_local_session_gets_its_own_folder():
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(ValueError):
        shared_dir(session("yarn"))
