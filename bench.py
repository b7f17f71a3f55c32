"""Time the headline queries and print one JSON line.

Each query is run to the end (results go to a sink that drops them), once to
warm up and then ``BENCH_RUNS`` times; the best time counts.  The last entries
profile lineitem with one job per column and metric family, to be held against
the profile in one scan.
"""

from __future__ import annotations

import json
import os
import time

from gaugewell.checks import inputs, registry
from gaugewell.operators.cells import to_cells
from gaugewell.operators.ranks import ranked_values
from gaugewell.operators.scalars import scalar_metrics
from gaugewell.session import local_session

HEADLINES = (
    "gp_profile_lineitem",
    "gp_scalar_all",
    "gp_distinct_exact",
    "gp_profile",
    "gp_ranked_documents",
    "so_union_profiles",
    "sw_profile",
    "sw_profile_table",
    "rq_top3_complaints",
    "rq_top_agency",
    "rq_daily",
    "rq_avg_close_days",
    "rq_complaints_over_time",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_by_one(spark, sf_dir: str, spread: bool) -> None:
    """The same metrics with one job per column and metric family."""
    df = inputs.table(spark, sf_dir, "lineitem", spread=spread)
    for name in df.columns:
        cells = to_cells(df.select(name))
        drain(scalar_metrics(cells))
        drain(ranked_values(cells))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus)
    queries = registry.queries()
    times: dict[str, float] = {}

    def best(run) -> float:
        run()
        found = []
        for _ in range(runs):
            start = time.perf_counter()
            run()
            found.append(time.perf_counter() - start)
        return round(min(found), 3)

    for key in HEADLINES:
        times[key] = best(lambda: drain(queries[key](spark, sf_dir)))
    total = round(sum(times.values()), 3)
    times["baseline_column_loop_lineitem"] = best(lambda: one_by_one(spark, sf_dir, False))
    times["baseline_column_loop_lineitem_spread"] = best(lambda: one_by_one(spark, sf_dir, True))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
