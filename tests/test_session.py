from __future__ import annotations

import pytest

from tidelake import session


class Settings:
    def __init__(self, values, checkpoint=None):
        self.values = values
        self.conf = self.sparkContext = self
        self.checkpoint = checkpoint

    def get(self, key, default=None):
        return self.values.get(key, default)

    def getCheckpointDir(self):  # noqa: N802
        return self.checkpoint


def test_the_named_folder_is_used():
    fake = Settings({"spark.checkpoint.dir": "hdfs://shared/state/"}, "file:/other")
    assert session.shared_folder(fake) == "hdfs://shared/state"
    assert session.new_folder(fake, "x") != session.new_folder(fake, "x")
    assert session.new_folder(fake, "x").startswith("hdfs://shared/state/tidelake/x-")


def test_else_the_folder_of_the_context():
    assert session.shared_folder(Settings({}, "file:/own")) == "file:/own"


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_no_folder_is_an_error(master):
    with pytest.raises(ValueError):
        session.shared_folder(Settings({"spark.master": master}))
