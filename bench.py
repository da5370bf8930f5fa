"""Benchmark: one full refresh of the model graph, timed per step.

Reads the driver tables under $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Each round lands the raw CRM tables (fixture mapping),
then materialises every model in dependency order, the way a scheduled
refresh runs; a step's time is the time to build it from its already
materialised inputs. One warm-up round, then the median of $BENCH_ROUNDS
(default 3) rounds per step. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from partnerlens.config import EngineConfig  # noqa: E402
from partnerlens.plans import forecast as FC  # noqa: E402
from partnerlens.plans.models import Models  # noqa: E402
from partnerlens.plans.refresh import INCREMENTAL, put_incremental  # noqa: E402
from partnerlens.session import drop_path, get_session, new_path  # noqa: E402
from partnerlens.sources.fixture import load_fixture  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_round(spark, sf_dir: str) -> dict[str, float]:
    cfg = EngineConfig()
    times: dict[str, float] = {}

    def step(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = time.perf_counter() - t
        return out

    def land():
        fx = load_fixture(spark, sf_dir, cfg)
        return fx.with_(**{n: stored(getattr(fx, n)) for n in fx.names()})

    def stored(df):
        path = new_path(spark, "bench")
        paths.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    paths: list[str] = []
    raw = step("land_raw_tables", land)
    m = Models(spark, raw, cfg, materialize="parquet")
    step("I4_stage_durations", lambda: m.stage_durations)
    step("I5_attribution", lambda: m.attribution)
    step("I3_sales_touches", lambda: run(m.sales_touches))
    step("K1_partner_leads", lambda: run(m.partner_leads))
    step("K2_partner_deals", lambda: m.partner_deals)
    step("K4_funnel", lambda: run(m.funnel))
    step("K5_lead_cohorts", lambda: run(m.lead_cohorts))
    step("K6_penetration", lambda: run(m.penetration))
    step("K7_rep_performance", lambda: run(m.rep_performance))
    step("K8_summary", lambda: (m.period_facts, m.summary))
    step("K9_rankings", lambda: run(m.rankings))
    step("F2_forecast", lambda: run(FC.forecast(FC.history(m.summary))))

    roots = {name: new_path(spark, "bench") for name in INCREMENTAL}
    for name, root in roots.items():  # what an earlier refresh has stored
        put_incremental(spark, name, getattr(m, name), root, full_refresh=True)

    def incremental():
        """Builds the look-back slices and merges them into the stored marts."""
        inc = m.incremental_copy()
        for name, root in roots.items():
            put_incremental(spark, name, getattr(inc, name), root, full_refresh=False, ready=True)

    step("A11_incremental_merge", incremental)
    times["full_refresh"] = sum(times.values())
    m.release()
    for path in [*paths, *roots.values()]:
        drop_path(spark, path)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(4, cpus * 2), app="partnerlens-bench")
    one_round(spark, sf_dir)  # warm-up: JIT, codegen caches, file listings
    samples = [one_round(spark, sf_dir) for _ in range(rounds)]
    med = {k: round(statistics.median(s[k] for s in samples), 3) for k in samples[0]}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "full_refresh_median", "value": med["full_refresh"], "unit": "sec",
                      "queries": med, "sf": sf, "cpus": cpus, "rounds": rounds}))


if __name__ == "__main__":
    main()
