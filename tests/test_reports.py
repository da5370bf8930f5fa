import datetime as dt

from pyspark.sql import functions as F

from partnerlens.plans import reports as R

AS_OF = dt.datetime(2002, 5, 15, 10, 0, 0)


def test_period_predicates_bounds(spark):
    months = [dt.date(2001, 5, 1), dt.date(2001, 6, 1), dt.date(2002, 1, 1), dt.date(2002, 3, 1), dt.date(2002, 4, 1),
              dt.date(2002, 5, 1), dt.date(2002, 9, 1)]
    rows = [("p1", "month", m) for m in months] + [("p1", "all_time", None), ("p1", "quarter", dt.date(2002, 4, 1))]
    df = spark.createDataFrame(rows, "partner_id string, period_type string, period_start_date date")

    def pick(period):
        return sorted(r.period_start_date for r in df.filter(R.period_predicate(period, AS_OF)).collect()
                      if r.period_start_date is not None)

    assert pick("ytd") == [dt.date(2002, 1, 1), dt.date(2002, 3, 1), dt.date(2002, 4, 1), dt.date(2002, 5, 1), dt.date(2002, 9, 1)]
    assert pick("last_12m")[0] == dt.date(2001, 6, 1)        # the month 11 months before this one starts the range
    assert pick("qtd") == [dt.date(2002, 4, 1), dt.date(2002, 5, 1), dt.date(2002, 9, 1)]  # open-ended, future month included
    assert pick("mtd") == [dt.date(2002, 5, 1)]
    assert df.filter(R.period_predicate("all", AS_OF)).count() == 1
    assert R.normalize_period("bogus") == "all" and R.normalize_period("qtd") == "qtd"


def test_totals_null_sums_are_zero(spark):
    empty = spark.createDataFrame([], "partner_id string, period_type string, period_start_date date, total_leads bigint, "
                                      "leads_reached_mql bigint, leads_reached_sql bigint, deals_closed_won bigint, "
                                      "total_deals_created bigint, revenue_closed_won decimal(28,2)")
    r = R.q_totals(empty, "mtd", AS_OF).first()
    assert (r.total_leads, r.deals_won, r.partners_active, float(r.revenue)) == (0, 0, 0, 0.0)


def test_deal_order_won_open_lost_latest_first(spark):
    rows = [("p", "d1", False, True, None, dt.datetime(2001, 1, 1), None),   # lost
            ("p", "d2", False, False, None, None, dt.datetime(2001, 2, 1)),   # open
            ("p", "d3", True, True, dt.datetime(2001, 3, 1), None, None),     # won, older
            ("p", "d4", True, True, dt.datetime(2001, 4, 1), None, None)]     # won, newer
    df = spark.createDataFrame(rows, "partner_id string, deal_id string, is_closed_won boolean, is_closed boolean, "
                                     "deal_closed_won_at timestamp_ntz, deal_close_date timestamp_ntz, deal_created_at timestamp_ntz")
    for c in ["deal_name", "deal_stage", "deal_status", "deal_owner_name", "deal_owner_email", "source_type"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    for c in ["amount", "time_to_close_days", "sales_touches_total"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    assert [r.deal_id for r in R.q_deals(df, "p").collect()] == ["d4", "d3", "d2", "d1"]
