import pytest

from lakeloom import shared


class Session:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_configured_folder_wins():
    session = Session(spark_checkpoint_dir="hdfs://x/ck/", spark_master="yarn")
    assert shared.shared_dir(session) == "hdfs://x/ck"
    assert shared.scratch_path(session, "a") != shared.scratch_path(session, "a")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared.shared_dir(Session(spark_master="yarn"))


def test_local_mode_has_a_folder():
    session = Session(spark_master="local[2]", spark_app_id="app")
    assert shared.shared_dir(session) == shared.shared_dir(session)
