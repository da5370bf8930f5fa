import datetime as dt


from pyspark.sql import functions as F

from partnerlens.operators import quality as T
from partnerlens.plans import publish as P

AS_OF = dt.datetime(2002, 1, 1, 12, 0, 0)


def test_freshness_thresholds(spark):
    out = []
    for hours in (5, 7, 25):
        df = spark.createDataFrame([(AS_OF - dt.timedelta(hours=hours),)], "_fivetran_synced timestamp_ntz")
        out.append(T.freshness(df, "t", "_fivetran_synced", AS_OF).first().status)
    assert out == ["pass", "warn", "error"]
    empty = spark.createDataFrame([], "_fivetran_synced timestamp_ntz")
    assert T.freshness(empty, "t", "_fivetran_synced", AS_OF).first().status == "error"


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([("a", "won", 0.5, 1), ("a", "weird", 1.5, 1), (None, None, None, 2)],
                               "k string, s string, r double, g int")
    checks = [T.Check("not_null", "m", ("k",)), T.Check("unique", "m", ("k",)),
              T.Check("accepted_values", "m", ("s",), values=("won", "lost", "open")),
              T.Check("accepted_range", "m", ("r",), min_value=0, max_value=1), T.Check("unique", "m", ("g",))]
    res = {r.check: (r.failures, r.status) for r in T.run_checks({"m": df}, checks).collect()}
    assert res["not_null:m.k"] == (1, "error")
    assert res["unique:m.k"] == (2, "error")          # nulls ignored, 'a' twice
    assert res["accepted_values:m.s"] == (1, "error")  # null passes
    assert res["accepted_range:m.r"] == (1, "error")   # null passes
    assert res["unique:m.g"] == (2, "error")


def test_close_before_create_is_a_warning(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 2), dt.datetime(2001, 1, 1)), (dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2))],
                               "deal_created_at timestamp_ntz, deal_close_date timestamp_ntz")
    r = T.run_checks({"partner_deals": df}, [T.close_before_create(df)]).first()
    assert (r.failures, r.status) == (1, "warn")


def test_publish_targets_and_log(spark):
    kinds = '{"Name": "title", "Leads": "number"}'
    rows = [("t1", "partner_summary", "db1", "{}", '{"total_leads": "Leads"}', kinds, [], True), ("t2", "secret_table", "db2", "{}", "{}", kinds, [], True),
            ("t3", "partner_rankings", "db3", "{}", "{}", kinds, [], False), ("t4", "partner_penetration", "db4", "{}", "{}", kinds, [], True),
            ("t5", "partner_rankings", "db5", "{}", '{"no_column": "Leads"}', kinds, [], True)]
    targets = spark.createDataFrame(rows, P.TARGET_SCHEMA)
    assert {r.id: r.known_source for r in P.publish_targets(targets).collect()} == {"t1": True, "t2": False, "t4": True, "t5": True}
    mart = spark.createDataFrame([("p1", "A", "all_time", 3), ("p2", "B", "month", 4)],
                                 "partner_id string, partner_name string, period_type string, total_leads int")
    broken = mart.withColumn("partner_name", F.when(F.col("total_leads") > 0, F.raise_error(F.lit("broken " * 200)).cast("string")))
    empty = spark.createDataFrame([], "title string, page_id string")
    sent = {}
    log = P.run_publish(spark, {"partner_summary": mart, "partner_penetration": broken, "partner_rankings": mart},
                        [P.target_from_row(r) for r in targets.collect()], {t: empty for t in ("t1", "t4", "t5")},
                        lambda t, plan: sent.update({t.id: [tuple(r) for r in plan.collect()]}), AS_OF)
    got = {r.target_id: (r.status, r.message) for r in log.collect()}
    assert got["t1"] == ("ok", "1 rows: 1 created, 0 updated") and sent["t1"] == [("t1", "create", None, "A", 3.0)]
    assert got["t2"] == ("error", "unknown source table: secret_table") and got["t5"] == ("error", "bad column name: no_column")
    assert got["t4"][0] == "error" and "broken" in got["t4"][1] and len(got["t4"][1]) == 500  # fails while it runs; the others go on
    assert set(got) == {"t1", "t2", "t4", "t5"}


def test_checks_read_each_table_once(spark, tmp_path):
    from partnerlens.operators import quality as Q

    spark.createDataFrame([(1, "a", None), (1, "a", "x"), (2, None, "x"), (None, None, "y"), (None, "b", "y")], "id int, v string, w string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(k, "ok") for k in range(5)], "id int, v string").write.parquet(str(tmp_path / "u"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in "tu"}
    c = Q.Check
    checks = [c("unique", "t", ("id",)), c("unique", "t", ("id", "v")), c("unique", "t", ("w",)), c("not_null", "t", ("v",)), c("accepted_values", "t", ("w",), values=("x",)),
              c("accepted_range", "t", ("id",), max_value=1), c("unique", "u", ("id",), severity="warn"), c("not_null", "u", ("v",))]
    out = Q.run_checks(tables, checks)
    assert [r.failures for r in sorted(out.collect(), key=lambda r: [x.label for x in checks].index(r["check"]))] == [2, 2, 4, 2, 2, 1, 0, 0]
    assert {r["check"]: r.status for r in out.collect()}["unique:u.id"] == "pass"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    keys = Q.failing_keys(tables, checks, {"t": ["id", "w"]}, 1)
    assert sorted((r["check"], r.failing_key, r.n) for r in keys.collect()) == [
        ("accepted_range:t.id", '{"id":2,"w":"x"}', 1), ("accepted_values:t.w", '{"w":"y"}', 2), ("not_null:t.v", '{"id":2,"w":"x"}', 1),
        ("unique:t.id", '{"id":1}', 2), ("unique:t.id+v", '{"id":1,"v":"a"}', 2), ("unique:t.w", '{"w":"x"}', 2)]


def test_every_staged_cast_is_declared():
    """The registry is the only place of the staging models that names a cast."""
    import inspect

    from partnerlens.operators import staging

    source = inspect.getsource(staging)
    assert source.count("safe_cast(") == 1
    assert all(f'"{name}")' in source.split("def typed(")[1] for casts in staging.CASTS.values() for name in casts)


def test_statuses_are_merged_into_the_stored_targets(spark, tmp_path):
    import datetime as dt

    from partnerlens.operators import merge as M
    from partnerlens.plans import publish as P

    path = str(tmp_path / "targets")
    M.write_keyed(spark.createDataFrame([("a", "db-a"), ("b", "db-b")], "id string, notion_database_id string"), path, ["id"])
    first, second = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    P.store_status(spark, path, P.publish_log(spark, [("a", "error", "x" * 600), ("b", "ok", "1 rows")], first))
    out = P.store_status(spark, path, P.publish_log(spark, [("a", "ok", None)], second))
    assert sorted((r.id, r.notion_database_id, r.last_sync_status, r.last_sync_message, r.last_synced_at) for r in out.collect()) == [
        ("a", "db-a", "ok", None, second), ("b", "db-b", "ok", "1 rows", first)]


def test_stored_counts_are_edited_and_deleted(spark, tmp_path):
    import datetime as dt

    from partnerlens.operators import merge as M
    from partnerlens.plans import publish as P

    path, day = str(tmp_path / "counts"), dt.date(2001, 1, 1)
    make = lambda *rows: spark.createDataFrame(list(rows), "partner_id string, as_of_date date, total_customer_count int, notes string")
    M.write_keyed(make(("p1", day, 5, None), ("p2", day, 6, "n")), path, P.COUNT_KEYS)
    out = P.store_counts(spark, path, make((" p1 ", day, 7, "ok"), ("p3", day, -1, None)))
    assert sorted(tuple(r[c] for c in ("partner_id", "total_customer_count", "notes")) for r in out.collect()) == [("p1", 7, "ok"), ("p2", 6, "n")]
    out = P.unstore_counts(spark, path, make(("p2", day, None, None)))
    assert [r.partner_id for r in out.collect()] == ["p1"]
