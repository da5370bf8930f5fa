import datetime as dt
import json
import os

from pyspark.sql import functions as F

from partnerlens.plans import publish as P
from partnerlens.sources import landing as L
from partnerlens.sources.fixture import contact_objects


def test_submission_values_last_wins_and_nameless_dropped(spark):
    df = spark.createDataFrame([([("email", "A@x.io"), ("industry", "a"), ("industry", "b"), ("", "junk"), (None, "n")],)],
                               "values array<struct<name:string,value:string>>")
    out = json.loads(df.select(L.submission_values(F.col("values")).alias("j")).first().j)
    assert out == {"email": "A@x.io", "industry": "b"}


def test_submission_key_and_resolve(spark):
    subs = spark.createDataFrame([(None, "f1", "1000", None, [("email", "USER@x.io")]),
                                  ("keep", "f1", None, None, [("email", "")])],
                                 "conversionId string, formId string, submittedAt string, pageUrl string, "
                                 "values array<struct<name:string,value:string>>")
    contacts = spark.createDataFrame([("9", "user@X.io"), ("3", "User@x.io"), ("5", "")], "id string, property_email string")
    out = {r.conversion_id: r.contact_id for r in L.resolve_contacts(L.land_submissions(subs), contacts).collect()}
    assert out == {"f1:1:USER@x.io": "3", "keep": None}


def test_stage_history_drops_incomplete_and_links_exit(spark):
    objs = spark.createDataFrame([("d1", ([("b", "2000"), ("a", "1000"), ("", "3000"), ("c", None), ("z", "junk")],), None)],
                                 "id string, propertiesWithHistory struct<dealstage:array<struct<value:string,timestamp:string>>>, "
                                 "associations struct<contacts:struct<results:array<struct<id:string>>>>")
    rows = sorted((r.stage_id, r.entered_at, r.exited_at) for r in L.land_stage_history(objs).collect())
    assert rows == [("a", dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 0, 2)),
                    ("b", dt.datetime(1970, 1, 1, 0, 0, 2), None)]


KINDS = {"Name": "title", "V": "number", "When": "date"}


def _plan(rows, existing, **target):
    t = P.Target(id="t", source_table="partner_rankings", database_id="db", kinds=KINDS, **target)
    return sorted((tuple(r) for r in P.publish_plan(rows, existing, t).collect()), key=str)


def test_publish_sends_every_row_and_matches_whole_titles(spark):
    long = "x" * 2000
    rows = spark.createDataFrame([("A", 1), ("A", 2), (" ", 3), (None, 4), (" B\n", 5), (long + "1", 6), (long + "2", 7)], "partner_name string, v int")
    existing = spark.createDataFrame([("A ", "page-a"), ("A", "page-b"), ("B", "page-c"), (long + "2", "page-d"), ("", "blank")], "title string, page_id string")
    out = _plan(rows, existing, column_map={"v": "V", "partner_name": "Name"})
    assert [(r[1], r[2], r[4]) for r in sorted(out, key=lambda r: r[4])] == [
        ("update", "page-b", 1.0), ("update", "page-b", 2.0), ("create", None, 3.0), ("update", "page-c", 5.0),
        ("create", None, 6.0), ("update", "page-d", 7.0)]
    assert max(len(r[3]) for r in out) == 2000


def test_publish_matches_on_title_and_key_columns(spark):
    rows = spark.createDataFrame([("A", "2001-01-01", 1), ("A", "2001-02-01", 2), ("A", None, 3)], "partner_name string, as_of string, v int")
    existing = spark.createDataFrame([("A", "2001-01-01", "p1"), ("A", None, "p3"), ("A", "1999-01-01", "p9")], "title string, as_of string, page_id string")
    out = _plan(rows, existing, column_map={"partner_name": "Name", "v": "V", "as_of": "When"}, key_columns=("as_of",))
    assert sorted((r[2] or "-", r[4]) for r in out) == [("-", 2.0), ("p1", 1.0), ("p3", 3.0)]


def test_publish_filters(spark):
    make = lambda **f: P.publish_filters(P.Target(id="t", source_table="partner_summary", database_id="d", filters=f))
    assert make() == {"period_type": "all_time"} and make(period_type="month", partner_id="p1") == {"period_type": "month"}
    assert make(period_type="") == make(period_type=None) == make(period_type=[]) == {}


def test_publish_values(spark):
    df = spark.createDataFrame([("12.5", "x", dt.datetime(2001, 1, 2, 3, 4, 5, 6), True, 0)], "a string, b string, t timestamp_ntz, f boolean, n int")
    kind = {f.name: f.dataType for f in df.schema.fields}
    value = lambda c, k: df.select(P.coerce(F.col(c), k, kind[c]).alias("v")).first().v
    assert (value("a", "number"), value("b", "number")) == (12.5, None)
    assert value("t", "date") == "2001-01-02T03:04:05.000006" and value("f", "rich_text") == "True"
    assert value("n", "checkbox") is False and value("b", "checkbox") is True


def test_counts_validation(spark):
    target = spark.createDataFrame([("p1", dt.date(2001, 1, 1), 5, None)], "partner_id string, as_of_date date, total_customer_count int, notes string")
    rows = spark.createDataFrame([("p1", dt.date(2001, 1, 1), 7, "ok"), ("", dt.date(2001, 1, 1), 1, None),
                                  ("p2", dt.date(2001, 1, 1), -1, None), ("p3", None, 1, None), ("p4", dt.date(2001, 1, 1), 1, "n" * 501)],
                                 "partner_id string, as_of_date date, total_customer_count int, notes string")
    out = sorted(tuple(r) for r in P.upsert_counts(target, rows).collect())
    assert out == [("p1", dt.date(2001, 1, 1), 7, "ok")]
    assert sorted(r.reason for r in P.rejected_counts(rows).collect()) == [
        "as_of_date is missing", "notes are over 500 characters", "partner_id is missing", "total_customer_count is negative"]
    assert P.delete_counts(target, target).count() == 0


def test_offsets_count_and_junk_is_null(spark):
    texts = ["2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00Z", "1704067200000", "2024-01-01", "12:30", "junk", "", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.v for r in df.select("k", L.parse_ts(F.col("t")).alias("v")).orderBy("k").collect()]
    day = dt.datetime(2024, 1, 1)
    assert got == [day - dt.timedelta(hours=2), day, day, day, None, None, None, None]


def test_a_deal_twice_in_a_batch_has_one_history(spark):
    objs = spark.createDataFrame([("d1", ([("a", "1000")],), "2024-01-01T00:00:00Z"), ("d1", ([("a", "1000"), ("b", "2000"), ("b", "2000")],), "2024-01-02T00:00:00Z")],
                                 "id string, propertiesWithHistory struct<dealstage:array<struct<value:string,timestamp:string>>>, updatedAt string")
    rows = sorted((r.stage_id, r.exited_at) for r in L.land_stage_history(objs).collect())
    assert rows == [("a", dt.datetime(1970, 1, 1, 0, 0, 2)), ("b", None)]


def test_landing_runs_go_on_from_their_state(spark, tmp_path):
    from partnerlens.plans.landing_run import landing_run, last_sync

    dumps, root = tmp_path / "dumps", str(tmp_path / "raw")
    (dumps / "contacts").mkdir(parents=True)
    line = lambda i, at, stage: json.dumps({"id": i, "updatedAt": at, "properties": {"lifecyclestage": stage}}) + "\n"
    (dumps / "contacts" / "a.json").write_text(line("1", "2001-12-01T00:00:00Z", "lead") + line("2", "2001-12-01T00:00:00Z", "lead"))
    start = dt.datetime(2001, 12, 10)
    assert last_sync(spark, root, "contact") is None
    landing_run(spark, str(dumps), root, start)  # the other kinds have no folder: they are skipped
    assert last_sync(spark, root, "contact") == start and last_sync(spark, root, "deal") is None
    (dumps / "contacts" / "b.json").write_text(line("1", "2001-12-11T00:00:00Z", "customer") + line("2", "2001-12-02T00:00:00Z", "too old"))
    tables = landing_run(spark, str(dumps), root, start + dt.timedelta(days=5))
    assert {r.id: r.property_lifecyclestage for r in tables["contact"].collect()} == {"1": "customer", "2": "lead"}


def test_objects_of_unknown_time_land_and_older_versions_do_not(spark, tmp_path):
    from partnerlens.plans.landing_run import landing_run

    dumps, root = tmp_path / "dumps", str(tmp_path / "raw")
    (dumps / "emails").mkdir(parents=True)
    for kind in ("calls", "meetings", "notes", "tasks"):
        (dumps / kind).mkdir()

    def dump(name, *rows):
        lines = [json.dumps({"id": i, **({"updatedAt": at} if at else {}), "properties": {"hubspot_owner_id": owner, **({"hs_lastmodifieddate": p} if p else {})}})
                 for i, at, p, owner in rows]
        (dumps / "emails" / name).write_text("\n".join(lines) + "\n")

    start = dt.datetime(2001, 12, 10)
    dump("a.json", ("1", "2001-12-20T00:00:00Z", None, "a"), ("2", None, None, "a"), ("3", None, "2001-12-01T00:00:00Z", "a"), ("4", "2001-12-01T00:00:00Z", None, "a"))
    landing_run(spark, str(dumps), root, start)
    dump("a.json", ("1", "2001-12-12T00:00:00Z", None, "older"), ("2", "?", None, "b"), ("3", "junk", "2001-12-12T00:00:00Z", "b"), ("4", "2001-12-02T00:00:00Z", None, "not read"),
         ("5", None, None, "b"))
    tables = landing_run(spark, str(dumps), root, start + dt.timedelta(days=5))
    assert {r.engagement_id: r.owner_id for r in tables["engagement"].collect()} == {"1": "a", "2": "b", "3": "b", "4": "a", "5": "b"}


def _stream(session, tmp_path, group):
    from partnerlens.streaming.landing_stream import start_landing_stream

    q = start_landing_stream(session, str(tmp_path / "dumps"), str(tmp_path / "raw"), str(tmp_path / f"progress-{group}"), group,
                             available_now=True, loaded_at=dt.datetime(2002, 1, 1))
    q.awaitTermination(180)
    return sum(p.numInputRows for p in q.recentProgress)


def test_a_restarted_stream_reads_no_file_twice(spark, models, tmp_path):
    from partnerlens.operators.merge import read_keyed

    src = tmp_path / "dumps" / "contacts"
    src.mkdir(parents=True)
    objs = contact_objects(models.raw.contact).limit(20).toJSON().collect()
    (src / "part-0.json").write_text("\n".join(objs[:12]) + "\n")
    assert _stream(spark, tmp_path, "contacts") == 12
    (src / "part-1.json").write_text("\n".join(objs[8:]) + "\n")  # overlapping keys: replaced, not repeated
    assert _stream(spark.newSession(), tmp_path, "contacts") == 12  # the second file alone
    out = read_keyed(spark, str(tmp_path / "raw" / "contact"))
    assert out.count() == 20 and out.select("id").distinct().count() == 20


def test_a_submission_finds_the_contact_that_lands_later(spark, tmp_path):
    from partnerlens.operators.merge import read_keyed

    for kind in ("contacts", "submissions"):
        (tmp_path / "dumps" / kind).mkdir(parents=True)
    sub = lambda i, email: json.dumps({"conversionId": i, "formId": "f", "submittedAt": "1000", "values": [{"name": "email", "value": email}]}) + "\n"
    contact = lambda i, email: json.dumps({"id": i, "updatedAt": "2001-01-01T00:00:00Z", "properties": {"email": email}}) + "\n"
    found = lambda: {r.conversion_id: r.contact_id for r in read_keyed(spark, str(tmp_path / "raw" / "contact_form")).collect()}
    (tmp_path / "dumps" / "contacts" / "a.json").write_text(contact("1", "known@x.io"))
    (tmp_path / "dumps" / "submissions" / "a.json").write_text(sub("s1", "KNOWN@x.io") + sub("s2", "later@x.io") + sub("s3", ""))
    assert _stream(spark, tmp_path, "contacts") == 4
    assert found() == {"s1": "1", "s2": None, "s3": None}
    (tmp_path / "dumps" / "contacts" / "b.json").write_text(contact("2", "Later@X.io"))
    assert _stream(spark, tmp_path, "contacts") == 1
    assert found() == {"s1": "1", "s2": "2", "s3": None}


def test_all_engagement_kinds_stream_into_one_table(spark, tmp_path):
    from partnerlens.operators.merge import read_keyed

    for k, kind in enumerate(L.ENGAGEMENT_TYPES):
        (tmp_path / "dumps" / kind).mkdir(parents=True)
        row = {"id": str(k), "properties": {"hs_timestamp": "1000"}, "associations": {"contacts": {"results": [{"id": "c"}]}}}
        (tmp_path / "dumps" / kind / "a.json").write_text(json.dumps(row) + "\n")
    assert _stream(spark, tmp_path, "engagements") == 5
    rows = read_keyed(spark, str(tmp_path / "raw" / "engagement")).collect()
    assert {r.engagement_source: r.engagement_type for r in rows} == L.ENGAGEMENT_TYPES
    assert read_keyed(spark, str(tmp_path / "raw" / "engagement_contact")).count() == 5


def test_a_landing_run_reads_and_sorts_out_deals_once(spark, tmp_path, monkeypatch):
    from partnerlens.plans import landing_run as R

    dumps, root, read, sorted_out = tmp_path / "dumps", str(tmp_path / "raw"), [], []
    (dumps / "deals").mkdir(parents=True)
    deal = lambda stage, at, n: json.dumps({
        "id": "d1", "updatedAt": at, "properties": {"dealname": stage}, "associations": {"contacts": {"results": [{"id": f"c{n}"}, {"id": f"c{n}"}]}},
        "propertiesWithHistory": {"dealstage": [{"value": stage, "timestamp": "1000"}, {"value": stage, "timestamp": "1000"}, {"value": "b", "timestamp": str(n)}]}}) + "\n"
    (dumps / "deals" / "a.json").write_text(deal("old", "2001-12-01T00:00:00Z", 2000) + deal("new", "2001-12-02T00:00:00Z", 3000))
    objects, latest = R.L.objects, R.L.latest_objects
    monkeypatch.setattr(R.L, "objects", lambda s, path, kind="object": read.append(path) or objects(s, path, kind))
    monkeypatch.setattr(R.L, "latest_objects", lambda objs: sorted_out.append(objs) or latest(objs))
    tables = R.landing_run(spark, str(dumps), root, dt.datetime(2001, 12, 10))
    assert [p for p in read if p.endswith("/deals")] == [f"{dumps}/deals"] and len([o for o in sorted_out if "updatedAt" in o.columns]) == 1
    assert [(r.deal_id, r.property_dealname) for r in tables["deal"].collect()] == [("d1", "new")]
    assert sorted((r.stage_id, r.entered_at, r.exited_at) for r in tables["deal_stage_history"].collect()) == [
        ("b", dt.datetime(1970, 1, 1, 0, 0, 3), None), ("new", dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 0, 3))]
    assert [r.contact_id for r in tables["deal_contact"].collect()] == ["c3000"]


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_a_history_is_put_in_order_inside_its_object(spark):
    objs = spark.createDataFrame([
        ("d1", ([("b", "2000"), ("a", "2000"), ("b", "2000"), (None, "1"), ("", "1"), ("c", "junk"), ("a", "1000")],), "x"), ("d2", ([],), "x"), ("d3", None, "x"),
        (None, ([("a", "1000")],), "x")],
        "id string, propertiesWithHistory struct<dealstage:array<struct<value:string,timestamp:string>>>, more string")
    rows = L.land_stage_history(objs, F.col("more"), once=True)
    at = lambda s: dt.datetime(1970, 1, 1, 0, 0, s)
    assert rows.columns == ["deal_id", "stage_id", "entered_at", "more", "exited_at"] and _shuffles(rows) == 0
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("d1", "a", at(1), "x", at(2)), ("d1", "a", at(2), "x", at(2)), ("d1", "b", at(2), "x", None), (None, "a", at(1), "x", None)]


def test_a_merge_deals_its_rows_once(spark, tmp_path, monkeypatch):
    from partnerlens.operators import merge as M

    at = lambda n: n and dt.datetime(2001, 1, n)
    make = lambda *rows: spark.createDataFrame([(k, k2, v, at(n)) for k, k2, v, n in rows], "k string, k2 string, v string, t timestamp_ntz")
    settled, plans = M._settled, []
    monkeypatch.setattr(M, "_settled", lambda *a: plans.append(settled(*a)) or plans[-1])
    put = lambda *rows, **how: sorted(map(tuple, M.merge_into(
        spark, str(tmp_path / "t"), make(*rows), ["k", "k2"], F.col("t"), **how).select("k", "k2", "v").collect()), key=str)
    assert put(("a", "x", "old", 1), ("a", "x", "new", 2), ("b", "x", "1", None), ("b", None, "n", 1), few=True) == [
        ("a", "x", "new"), ("b", "x", "1"), ("b", None, "n")]
    # Older than the stored one, of equal time, of unknown time on either side, a key with a null (never known already), a new one.
    out = put(("a", "x", "older", 1), ("a", "x", "none", None), ("b", "x", "2", 1), ("b", None, "m", 2), ("c", "x", "3", 1), few=True)
    assert out == [("a", "x", "new"), ("b", "x", "2"), ("b", None, "m"), ("b", None, "n"), ("c", "x", "3")]
    assert put(("a", "x", "same", 2), ("c", "x", "4", None), once=True) == [
        ("a", "x", "same"), ("b", "x", "2"), ("b", None, "m"), ("b", None, "n"), ("c", "x", "4")]
    assert [_shuffles(p) for p in plans] == [1, 1, 1]


def test_the_deals_dump_holds_each_version_and_shuffles_narrow_rows(spark, tmp_path):
    from partnerlens.sources import fixture as FX

    day, root, as_of = dt.datetime(2000, 1, 3), str(tmp_path), "2002-01-01 00:00:00"
    tables = {
        "nation": ([(1, "N1"), (2, "N2")], "n_nationkey int, n_name string"),
        "customer": ([(3, 1), (4, None), (4, 2), (4, 2), (5, 9)], "c_custkey bigint, c_nationkey int"),
        "orders": ([(k, c, "F", 12.5, day, "1-URGENT") for k, c in [(10, 3), (10, 4), (11, 4), (11, 4), (15, 4), (20, 5), (22, 99), (23, None), (None, 3)]],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k, n, at) for k, n, at in [(10, 1, day), (10, 1, day), (10, 2, day), (11, None, day), (11, 3, None), (22, 9, day), (None, 1, day), (99, 1, day)]],
                     "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    plain = FX.deal_property_objects(FX.deals(spark, root, as_of)).join(FX.deal_objects(spark, root), "id", "left")
    key = F.col("id").cast("bigint")
    older = plain.filter(key % 11 == 0).withColumn("properties", F.map_concat(
        F.map_filter("properties", lambda k, _: k != "dealstage"), F.create_map(F.lit("dealstage"), F.lit("older")))).withColumn(
        "updatedAt", FX._iso(FX._days(F.to_timestamp("updatedAt").cast("timestamp_ntz"), F.lit(-400))))
    now = FX.whole_deal_objects(spark, root, as_of)

    def found(objs):
        dumped = [json.loads(r) for r in objs.toJSON().collect()]
        for o in dumped:
            o.get("propertiesWithHistory", {}).get("dealstage", []).sort(key=str)
        return sorted(json.dumps(o) for o in dumped)

    expected = found(plain.unionByName(older))
    assert len(expected) == 24 and found(now) == expected
    assert _shuffles(now) < _shuffles(plain.unionByName(older))
