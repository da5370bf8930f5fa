"""Hand-made fixtures for the helpers that carry the model graph, checked
against brute force (the exact rule written out in Python)."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from partnerlens.config import EngineConfig
from partnerlens.operators import intermediate as I
from partnerlens.operators import marts as K
from partnerlens.operators import merge as M
from partnerlens.operators.joins import asc_nulls_last, first_per_key, or_equi_join

CFG = EngineConfig()


def test_first_per_key_nulls_last_and_ties(spark):
    rows = [("d1", "c2", True, dt.datetime(2001, 1, 2)), ("d1", "c1", True, dt.datetime(2001, 1, 2)),
            ("d1", "c0", False, dt.datetime(2000, 1, 1)), ("d2", "c5", False, None), ("d2", "c4", False, dt.datetime(2002, 1, 1))]
    df = spark.createDataFrame(rows, "deal_id string, contact_id string, is_primary_contact boolean, contact_created_at timestamp_ntz")
    out = {r.deal_id: r.contact_id for r in first_per_key(
        df, ["deal_id"], [~F.col("is_primary_contact"), *asc_nulls_last(F.col("contact_created_at")), F.col("contact_id")],
        ["contact_id"]).collect()}
    # flagged first, then earliest created, then smallest id; a null creation time sorts last
    assert out == {"d1": "c1", "d2": "c4"}


def test_or_equi_join_matches_or_condition(spark):
    left = spark.createDataFrame([("a", "x", "y"), ("b", "x", "x"), ("c", None, "z"), ("d", "q", None)], "id string, k1 string, k2 string")
    right = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "key string, v int")
    got = sorted(tuple(r) for r in or_equi_join(left, [F.col("k1"), F.col("k2")], right, "key").select("id", "v").collect())
    brute = sorted({(i, v) for i, k1, k2 in left.collect() for key, v in right.collect() if key in (k1, k2)})
    assert got == brute


def test_exact_median_matches_numpy(spark):
    rnd = random.Random(7)
    rows = [(g, float(rnd.randint(0, 50))) for g in "abc" for _ in range(rnd.randint(1, 30))] + [("d", None)]
    rows += [("hot", float(rnd.randint(0, 100000))) for _ in range(5000)]
    rows += [(None, float(x)) for x in (4, 1, 3)]  # a null group key (all_time periods) must still match
    df = spark.createDataFrame(rows, "g string, v double")
    for acc in (10_000, 100, 1):
        got = {r.g: r.m for r in K.exact_quantile(df, ["g"], "v", "m", accuracy=acc).collect()}
        for g in ["a", "b", "c", "hot", None]:
            vals = [v for gg, v in rows if gg == g]
            assert abs(got[g] - float(np.median(vals))) < 1e-9, (acc, g)
        assert "d" not in got  # a group with only nulls has no median row (left join gives null)


def test_exact_quantile_matches_numpy(spark):
    rnd = random.Random(9)
    rows = [(g, rnd.random() * 100) for g in "ab" for _ in range(rnd.randint(1, 40))] + [("hot", float(rnd.randint(0, 9999))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.1, 0.9, 0.99, 1.0):
        got = {r.g: r.m for r in K.exact_quantile(df, ["g"], "v", "m", q, accuracy=100).collect()}
        for g in ("a", "b", "hot"):
            assert abs(got[g] - float(np.quantile([v for x, v in rows if x == g], q))) < 1e-9


def test_quantile_of_counted_values(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.choice([-5.5, 0.0, 1.25, 7.0, 7.0001, 900.0, 1e9]), rnd.randint(1, 9)) for g in "abc" for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    for q in (0.0, 0.5, 0.9):
        got = {r.g: r.m for r in K.exact_quantile(df, ["g"], "v", "m", q, weight="n").collect()}
        assert all(abs(got[g] - float(np.quantile([v for x, v, n in rows if x == g for _ in range(n)], q))) < 1e-6 for g in "abc")


def test_quantile_reads_its_input_twice_and_sorts_by_range(spark, tmp_path):
    spark.range(0, 20_000, 1, 7).selectExpr("id % 2 g", "cast((id * 7919) % 10007 as double) / 7 v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for accuracy in (1, 50, 1000):  # from a few wide ranges, with thousands of values each, to narrow ones
        out = K.exact_quantile(df, ["g"], "v", "m", 0.37, accuracy=accuracy)
        rows = df.collect()
        assert {r.g: round(r.m, 9) for r in out.collect()} == {g: round(float(np.quantile([r.v for r in rows if r.g == g], 0.37)), 9) for g in (0, 1)}
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2
        assert "percentile" not in plan and all("_range" in w or "[g#" in w for w in plan.split("\n") if "Window [" in w)


def test_ranks_equal_the_global_window(spark):
    from pyspark.sql import Window

    from partnerlens.operators.ranges import ranks_desc

    rnd = random.Random(8)
    rows = [(k, rnd.choice([None, 0, 1, 1, 2, 50, -3]), rnd.choice([None, 0.0, -0.0, 0.25, 1 / 3, 1e-9, -2.5, 1e12]),
             rnd.choice([None, "12.30", "12.31", "99999999999999999.98", "99999999999999999.99", "-4.00"])) for k in range(300)]
    df = spark.createDataFrame(rows, "id int, n long, x double, d string").withColumn("d", F.col("d").cast("decimal(28,2)"))
    got = ranks_desc(df, "id", {"n": "rn", "x": "rx", "d": "rd"}, fineness=2)
    want = df.select("id", *[F.rank().over(Window.orderBy(F.col(c).desc_nulls_last())).cast("long").alias(f"r{c}") for c in ("n", "x", "d")])
    assert sorted(map(tuple, got.select("id", "rn", "rx", "rd").collect())) == sorted(map(tuple, want.collect()))
    assert ranks_desc(df.limit(0), "id", {"n": "rn"}).count() == 0


def _touch_fixture(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2001, 1, 1)
    deals, prim, eng = [], [], []
    for d in range(40):
        c = f"c{d % 5}"
        created = t0 + dt.timedelta(days=rnd.randint(0, 30))
        close = None if d % 4 == 0 else created + dt.timedelta(days=rnd.randint(-3, 20))
        deals.append((f"d{d}", created if d % 13 else None, close))
        if d % 9:
            prim.append((f"d{d}", c))
    for e in range(300):
        eng.append((f"c{e % 6}", f"e{e % 250}", t0 + dt.timedelta(days=rnd.randint(0, 60), hours=rnd.randint(0, 3)),
                    rnd.choice(["email", "call", "meeting", "note"]), rnd.choice(["outgoing", "incoming", None])))
    # exact bound hits
    eng.append(("c1", "e_edge", deals[1][1], "call", None))
    return deals, prim, eng


def test_sales_touches_equals_interval_join(spark):
    deals, prim, eng = _touch_fixture(spark)
    d = spark.createDataFrame(deals, "deal_id string, deal_created_at timestamp_ntz, deal_close_date timestamp_ntz")
    p = spark.createDataFrame(prim, "deal_id string, primary_contact_id string")
    ce = spark.createDataFrame(eng, "contact_id string, engagement_id string, engaged_at timestamp_ntz, engagement_type string, email_direction string")
    got = {r.deal_id: (r.total_touches, r.outbound_emails, r.calls, r.meetings) for r in I.sales_touches(d, p, ce, CFG).collect()}
    pc = dict(prim)
    seen = {}
    for c, e, t, typ, dirn in eng:  # distinct (contact, engagement): keep the first occurrence
        seen.setdefault((c, e), (t, typ, dirn))
    for deal_id, created, close in deals:
        hi = close or CFG.as_of
        hits = {e: v for (c, e), v in seen.items() if c == pc.get(deal_id) and created is not None and created <= v[0] <= hi}
        want = (len(hits), sum(1 for v in hits.values() if v[1] == "email" and v[2] == "outgoing"),
                sum(1 for v in hits.values() if v[1] == "call"), sum(1 for v in hits.values() if v[1] == "meeting"))
        assert got[deal_id] == want, deal_id


def test_upsert_last_write_wins_and_idempotent(spark):
    target = spark.createDataFrame([("1", "a", 1), ("2", "b", 1)], "id string, v string, seq int")
    rows = spark.createDataFrame([("2", "b2", 3), ("2", "b1", 2), ("3", "c", 1)], "id string, v string, seq int")
    once = M.upsert(target, rows, ["id"], "seq")
    twice = M.upsert(once, rows, ["id"], "seq")
    want = [("1", "a", 1), ("2", "b2", 3), ("3", "c", 1)]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_upsert_adds_new_columns(spark):
    target = spark.createDataFrame([("1", "a")], "id string, v string")
    rows = spark.createDataFrame([("2", "b", 5)], "id string, v string, extra int")
    out = sorted(tuple(r) for r in M.upsert(target, rows, ["id"]).select("id", "v", "extra").collect())
    assert out == [("1", "a", None), ("2", "b", 5)]


def test_explode_periods_drops_null_dates_for_metrics(spark):
    df = spark.createDataFrame([("x", dt.date(2001, 2, 1), dt.date(2001, 1, 1)), ("y", None, None)], "id string, m date, q date")
    got = sorted((r.id, r.period_type) for r in K.explode_periods(df, "m", "q").collect())
    assert got == [("x", "all_time"), ("x", "month"), ("x", "quarter"), ("y", "all_time")]
    assert K.explode_periods(df, "m", "q", keep_null_dates=True).count() == 6


def test_upsert_keeps_target_only_columns_and_takes_given_nulls(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "stay")], "id int, v string, extra string")
    rows = spark.createDataFrame([(1, None, 9), (3, "new", 7)], "id int, v string, seq int")
    out = sorted((tuple(r) for r in M.upsert(target, rows, ["id"], "seq").select("id", "v", "extra", "seq").collect()), key=str)
    assert out == [(1, None, "keep", 9), (2, "b", "stay", None), (3, "new", None, 7)]


def test_latest_per_key_with_null_and_equal_sequence(spark):
    rows = spark.createDataFrame([(1, "old", None), (1, "new", 5), (2, "only", None), (3, "x", 1), (3, "y", 1)], "id int, v string, seq int")
    got = {r.id: r.v for r in M.latest_per_key(rows, ["id"], "seq").collect()}
    assert got[1] == "new" and got[2] == "only" and got[3] in "xy"
    again = {r.id: r.v for r in M.latest_per_key(rows.orderBy(F.desc("v")).repartition(3), ["id"], "seq").collect()}
    assert again == got  # whatever the order of the rows


def test_source_marker_attribution_is_opt_in(spark):
    from partnerlens.operators import staging as S

    contacts = spark.createDataFrame(
        [("c1", "partner", None, None, None, None, None, None)],
        "contact_id string, lead_origin_declared string, lead_source_declared string, referring_partner_declared string, "
        "original_source string, original_source_drill_down_1 string, original_source_drill_down_2 string, "
        "contact_created_at timestamp_ntz")
    partners = S.stg_partners(spark.createDataFrame([("p1", "Acme", None, "gold", None)],
                                                    "partner_id string, partner_name string, partner_domain string, "
                                                    "partner_tier string, partner_start_date date"))
    deals = spark.createDataFrame([], "deal_id string, deal_created_at timestamp_ntz, referring_partner_deal string, "
                                      "is_partner_sourced_deal boolean")
    edges = spark.createDataFrame([], "deal_id string, contact_id string, is_primary_contact boolean")
    forms = spark.createDataFrame([], "contact_id string, submission_id string, submitted_at timestamp_ntz, "
                                      "partner_name_from_form string, is_partner_referral_form boolean")
    ce = spark.createDataFrame([], "contact_id string, engagement_id string, engaged_at timestamp_ntz, engagement_type string, "
                                   "email_direction string, email_from_domain string")
    off = I.attribution(contacts, partners, deals, edges, forms, ce, CFG)
    assert off.count() == 0
    on = I.attribution(contacts, partners, deals, edges, forms, ce, EngineConfig(use_source_marker_attribution=True)).collect()
    assert [(r.contact_id, r.partner_id, r.attribution_method) for r in on] == [("c1", None, "lead_source_marker")]


def _files(root):
    import os

    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def _sorted(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_stored_tables_change_by_bucket(spark, tmp_path):
    root, make = str(tmp_path / "t"), spark.createDataFrame
    assert M.read_keyed(spark, root) is None and M.delete_from(spark, root, make([(1,)], "id int"), ["id"]) is None
    M.merge_into(spark, root, make([(k, "a", "keep") for k in range(40)], "id int, v string, extra string"), ["id"])
    before = _files(root)
    for _ in range(2):  # merged again: the same table
        out = M.merge_into(spark, root, make([(1, "c", 7), (99, "d", 8)], "id int, v string, more int"), ["id"])
    want = [(k, "c" if k == 1 else "a", "keep", 7 if k == 1 else None) for k in range(40)] + [(99, "d", None, 8)]
    assert _sorted(out, "id", "v", "extra", "more") == sorted(want, key=str) and set(out.columns) == {"id", "v", "extra", "more"}
    kept = before & _files(root)
    assert len(before) - 2 <= len(kept) < len(before)  # the buckets of 1 and 99 alone were written
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    out = M.delete_from(spark, root, make([(1,), (2,), (1000,)], "id int"), ["id"])
    assert {r.id for r in out.collect()} == {*range(40), 99} - {1, 2}
    out = M.delete_from(spark, root, out.select("id"), ["id"])
    assert out is None or out.count() == 0
    M.write_keyed(make([(9, "z")], "id int, v string"), root, ["id"])
    assert _sorted(M.read_keyed(spark, root), "id", "v") == [(9, "z")]
    assert _sorted(M.merge_into(spark, root, make([], "id int, v string"), ["id"]), "id", "v") == [(9, "z")]


def test_an_older_version_does_not_win(spark, tmp_path):
    root = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame([(i, v, t) for i, v, t in rows], "id int, v string, t int")
    put = lambda df: M.merge_into(spark, root, df, ["id"], F.col("t"))
    put(make((1, "a", 5), (2, "a", 5), (3, "a", None)))
    put(make((1, "old", 4), (2, "same", 5), (3, "b", 1), (4, "new", 1)))
    out = put(make((1, "older", 3), (2, "unknown", None), (2, "older", 2)))
    assert _sorted(out, "id", "v") == [(1, "a"), (2, "same"), (3, "b"), (4, "new")]
    out = put(make((2, "unknown", None)))
    assert _sorted(out, "id", "v")[1] == (2, "unknown")


def test_rows_move_between_months(spark, tmp_path):
    root, month = str(tmp_path / "t"), lambda m: None if m is None else dt.date(2001, m, 1)
    make = lambda *rows: spark.createDataFrame([(i, month(m), v) for i, m, v in rows], "id int, m date, v string")
    M.write_keyed(make((1, 1, "a"), (2, 1, "a"), (3, 2, "a"), (4, 3, "a"), (5, None, "a")).repartition(5), root, ["id"], by="m")
    before = _files(root)
    assert len(before) == 4  # a file for each month, not for each task
    out = M.merge_into(spark, root, make((3, 1, "b"), (5, None, "c"), (6, None, "d")), ["id"], by="m")
    assert _sorted(out, "id", "m", "v") == sorted([(1, month(1), "a"), (2, month(1), "a"), (3, month(1), "b"), (4, month(3), "a"), (5, None, "c"), (6, None, "d")], key=str)
    assert [f for f in before & _files(root)] == [f for f in before if "2001-03" in f]
    plan = M.read_keyed(spark, root).filter(F.col("m") == month(3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    out = M.delete_from(spark, root, spark.createDataFrame([(5,), (6,), (4,)], "id int"), ["id"], by="m")
    assert {r.id for r in out.collect()} == {1, 2, 3} and all("2001-01" in f for f in _files(root))
