import os

import pytest

from daybook import session
from daybook.operators import ids
from daybook.operators.ids import sequential_id


class Cluster:
    """A session of a cluster, as far as the workspace looks at it."""

    def __init__(self, folder):
        self.folder, self.conf, self.sparkContext, self.master = folder, self, self, "spark://host:7077"

    def get(self, _key, default=None):
        return self.folder or default


def test_workspace_lies_in_the_shared_folder():
    first, second = (session.workspace(Cluster("hdfs:///shared/"), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/daybook/x-") and first != second


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.workspace(Cluster(None), "x")


def test_scratch_databases_are_dropped(spark):
    name = session.scratch_database(spark, "gone")
    spark.range(3).write.saveAsTable(f"{name}.t")
    session.drop_scratch_databases(spark)
    assert not spark.catalog.databaseExists(name)


def test_databases_of_others_survive(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS daybook_x")
    spark.sql("CREATE TABLE IF NOT EXISTS daybook_x.t (id int) USING parquet")
    session.scratch_database(spark, "mine")
    session.drop_scratch_databases(spark)
    assert spark.catalog.tableExists("daybook_x.t")
    spark.sql("DROP DATABASE daybook_x CASCADE")


def test_workspaces_are_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_folders", set())
    monkeypatch.setattr(session, "_databases", set())
    made = []
    real = session.workspace

    def kept(spark, label):
        made.append(real(spark, label))
        return made[-1]

    monkeypatch.setattr(ids, "workspace", kept)
    assert sequential_id(spark.range(50), "row", "id").count() == 50
    assert os.path.exists(made[0])
    session.clear_workspaces(spark)
    assert not os.path.exists(made[0])


def test_larger_input_gives_more_partitions(spark, monkeypatch):
    small, large = spark.range(100), spark.range(10_000_000_000)
    assert session.estimated_bytes(small) == 800
    assert session.estimated_bytes(small, large) == 80_000_000_800
    assert session.estimated_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) == 0
    have = int(spark.conf.get(session.SHUFFLE_PARTITIONS))
    assert ids.id_partitions(small) == have < ids.id_partitions(large) == 382
    try:
        assert session.size_shuffles(spark, 800) == have
        assert session.size_shuffles(spark, 80_000_000_800) == 382
        assert int(spark.conf.get(session.SHUFFLE_PARTITIONS)) == 382
        assert session.size_shuffles(spark, 0) == 382
    finally:
        spark.conf.set(session.SHUFFLE_PARTITIONS, str(have))


def test_settings_that_maintenance_needs(spark):
    spark.conf.set(session.DYNAMIC_OVERWRITE, "STATIC")
    spark.conf.set(session.SPLIT_SKEW, "false")
    session.ensure_dynamic_overwrite(spark)
    session.ensure_skew_splits(spark)
    assert spark.conf.get(session.DYNAMIC_OVERWRITE) == "dynamic"
    assert spark.conf.get(session.SPLIT_SKEW) == "true"


def test_job_session_is_stopped_even_on_failure(monkeypatch):
    stops = []

    class Session:
        def stop(self):
            stops.append(1)

    monkeypatch.setattr(session, "build_session", lambda name, **settings: Session())
    monkeypatch.setattr(session, "clear_workspaces", lambda spark: None)
    assert session.run_job("x", lambda spark: 5) == 5
    with pytest.raises(ZeroDivisionError):
        session.run_job("x", lambda spark: 1 / 0)
    assert len(stops) == 2


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(100 * 1024**4) == 524_288
