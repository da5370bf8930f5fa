"""Broadcasts and shuffle partitions stay bounded, whatever the session came with."""

import pytest

from partnerlens.session import BROADCAST_BYTES, PARTITION_BYTES, _bytes, prepare_session

STATIC, LATE, SIZE = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                      "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.fixture
def fresh(spark):
    """A session with Spark's own settings."""
    s = spark.newSession()
    for name in (STATIC, LATE, SIZE):
        s.conf.unset(name)
    return s


def test_many_keys_are_not_broadcast(fresh, tmp_path):
    """Keys whose file is under Spark's 10 MB, but whose hash table in the driver is not small."""
    path = str(tmp_path / "keys")
    fresh.range(300_000).selectExpr("cast(id as string) k").write.parquet(path)
    prepare_session(fresh)
    keys = fresh.read.parquet(path)
    joined = fresh.range(600_000).selectExpr("cast(id as string) k", "id").join(keys, "k")
    assert joined.count() == 300_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    joined.collect()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_few_rows_are_broadcast(fresh, tmp_path):
    path = str(tmp_path / "few")
    fresh.range(25).write.parquet(path)
    prepare_session(fresh)
    assert "BroadcastHashJoin" in fresh.range(600_000).join(fresh.read.parquet(path), "id")._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_lowered(fresh):
    prepare_session(fresh)
    assert _bytes(fresh.conf.get(STATIC)) == BROADCAST_BYTES and _bytes(fresh.conf.get(SIZE)) == PARTITION_BYTES
    fresh.conf.set(LATE, "30MB")
    prepare_session(fresh)
    assert _bytes(fresh.conf.get(LATE)) == BROADCAST_BYTES


def test_lower_sizes_stay(fresh):
    for name, value in ((STATIC, "-1"), (LATE, "64k"), (SIZE, "8m")):
        fresh.conf.set(name, value)
    prepare_session(fresh)
    assert [fresh.conf.get(n) for n in (STATIC, LATE, SIZE)] == ["-1", "64k", "8m"]


def test_kept_models_leave_no_garbage_in_the_driver(spark, tmp_path):
    """A model that is kept ends with a full collection: what its plan and its tasks left is not held until the heap is full."""
    from partnerlens.config import EngineConfig
    from partnerlens.plans.models import Models

    def collections():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())

    models = Models(spark, None, EngineConfig(), materialize="parquet")
    before = collections()
    kept = models.keep(spark.range(10))
    assert collections() > before and kept.count() == 10
    models.release()


def test_letting_go_ends_with_a_small_query(spark, monkeypatch):
    from partnerlens import session as S

    # Spark's event queues hold the query that ended last, with its shuffle files, until another one ends.
    done, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, *a, **b: done.append(a[0]) or sql(self, *a, **b))
    monkeypatch.setattr(S.gc, "collect", lambda: done.append("gc"))
    S.let_go(spark)
    assert done == ["select 1", "gc"]
