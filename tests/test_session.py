import os

from pyspark.sql import SparkSession

from tastemap import session


def test_submitted_settings_stay(monkeypatch):
    """Master, partition count and heap are set only when given."""
    monkeypatch.delenv("TASTEMAP_DRIVER_MEMORY", raising=False)
    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, value):
            seen["master"] = value
            return self

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            return SparkSession.getActiveSession()

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    monkeypatch.setattr(Builder, "getOrCreate", lambda self: type("S", (), {
        "sparkContext": type("C", (), {"setLogLevel": lambda self, x: None})()})())
    session.build_session()
    assert not {"master", "spark.sql.shuffle.partitions", "spark.driver.memory"} & set(seen)
    session.build_session(master="local[2]", shuffle_partitions=3)
    assert seen["master"] == "local[2]" and seen["spark.sql.shuffle.partitions"] == "3"


def test_scratch_scope_removes_its_tables_only(spark):
    from tastemap.session import scratch_scope
    from tastemap.sources.files import materialize
    before = materialize(spark.range(5), "kept")
    with scratch_scope(spark):
        inside = materialize(spark.range(7), "gone")
        assert inside.count() == 7
        folder = inside.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        while folder.startswith("//"):
            folder = folder[1:]
        assert os.path.isdir(folder)
    assert before.count() == 5 and not os.path.exists(folder)
