"""Checkpoint folder: the cluster's setting wins; a local one only when unset."""

import os

from hebdo.session import SESSION_DEFAULTS, checkpoint_dir, materialize


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, current=None):
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, conf, current=None):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(current)


def test_checkpoint_dir_prefers_context_then_setting_then_local():
    assert checkpoint_dir(_Session({}, current="hdfs://shared/ckpt/x")) == "hdfs://shared/ckpt/x"
    assert checkpoint_dir(_Session({"spark.checkpoint.dir": "hdfs://shared/ckpt"})) == "hdfs://shared/ckpt"
    local = checkpoint_dir(_Session({}))
    assert os.path.isdir(local) and os.path.basename(local).startswith("hebdo-ckpt-")


def test_materialize_writes_under_the_session_folder(spark):
    folder = checkpoint_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    df = materialize(spark.range(10))
    assert df.count() == 10
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_session_defaults_are_applied(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert SESSION_DEFAULTS["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_checkpoint_dir_without_a_context():
    class _NoContext(_Session):
        @property
        def sparkContext(self):
            raise RuntimeError("no JVM context (Spark Connect)")

        @sparkContext.setter
        def sparkContext(self, value):
            pass

    assert checkpoint_dir(_NoContext({"spark.checkpoint.dir": "s3://shared/ckpt"})) == "s3://shared/ckpt"


def test_package_exports_resolve():
    import hebdo
    missing = [name for name in hebdo.__all__ if not hasattr(hebdo, name)]
    assert not missing
