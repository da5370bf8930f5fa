import datetime as dt
import os

from pyspark.sql import functions as F

from partnerlens.sources import landing as L
from partnerlens.sources.tables import SCHEMAS, conform, load_raw, seed, write_table


def test_forms_need_an_id(spark):
    forms = spark.createDataFrame([("1", None, "A"), (None, "g2", "B"), (None, None, "C")], "id string, guid string, name string")
    assert sorted(tuple(r) for r in L.land_forms(forms).collect()) == [("1", "A"), ("g2", "B")]


def test_objects_since_and_state(spark):
    objs = spark.createDataFrame([("a", "2001-12-30T00:00:00Z"), ("b", "2001-01-01T00:00:00Z"), ("c", "1009756800000")],
                                 "id string, updatedAt string")
    wm = dt.datetime(2001, 12, 1)
    assert sorted(r.id for r in L.objects_since(objs, wm).collect()) == ["a", "c"]
    assert L.objects_since(objs, None).count() == 3  # no state: full scan
    st = L.sync_state(spark, "deals", dt.datetime(2002, 1, 1)).first()
    assert st.last_sync_at == dt.datetime(2002, 1, 1)


def test_seed_csv_blank_is_null_and_typed(spark, tmp_path):
    p = tmp_path / "ref_partners.csv"
    p.write_text("partner_id,partner_name,partner_domain,partner_tier,partner_start_date\n"
                 "p1,Acme,,gold,2020-01-01\n")
    r = seed(spark, str(p), "ref_partners").first()
    assert r.partner_domain is None and r.partner_start_date == dt.date(2020, 1, 1)


def test_raw_scan_conforms_and_partitioned_sink(spark, models, tmp_path):
    root = str(tmp_path / "raw")
    for n in SCHEMAS:
        if n in ("ref_partners", "partner_total_customers"):
            continue
        df = getattr(models.raw, n, None)
        if df is None:
            df = spark.createDataFrame([], SCHEMAS[n])
        write_table(df, os.path.join(root, n))
    for n, f in (("ref_partners", models.raw.ref_partners), ("partner_total_customers", models.raw.partner_total_customers)):
        f.toPandas().to_csv(os.path.join(root, f"{n}.csv"), index=False)
    raw = load_raw(spark, root)
    assert raw.contact.count() == models.raw.contact.count()
    assert raw.contact.schema == SCHEMAS["contact"]
    # additive evolution: a missing column comes back as a typed null
    thin = conform(models.raw.owner.drop("team_id"), SCHEMAS["owner"])
    assert thin.filter(F.col("team_id").isNotNull()).count() == 0
    # mart sink partitioned by month
    out = str(tmp_path / "leads")
    write_table(models.partner_leads, out, partition_by=["lead_created_month"])
    assert spark.read.parquet(out).count() == models.partner_leads.count()
