"""Time the headline work and print one JSON line.

Two loads of the given tables (an earlier snapshot, then the rest), the reports and analytic questions over the
published star schema, the same reports straight from the given tables, the features and a model run.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from parcelqueries import load_queries, mapping, report_queries, risk_queries
from parcelmart.plans import analytics
from parcelmart.plans.features import late_delivery_features
from parcelmart.plans.late_model import run_late_model
from parcelmart.plans.load import core_tables, run_load
from parcelmart.shared import local_session


def run_all(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def questions(reports: dict) -> dict:
    def months():
        return analytics.in_months(reports["r1"](), mapping.FIRST_MONTH, mapping.LAST_MONTH)

    by_source = {
        months: [
            analytics.revenue_per_year, analytics.share_of_total, analytics.share_of_year, analytics.running_totals,
            analytics.best_months_per_year, analytics.month_over_month, analytics.moving_average,
            analytics.best_and_worst_month, analytics.versus_average_month, analytics.orders_year_to_date,
            analytics.months_above_moving_average,
        ],
        reports["r2"]: [
            analytics.best_categories, analytics.category_quartiles, analytics.revenue_per_quartile,
            analytics.biggest_categories_share, analytics.behind_previous_category,
        ],
        reports["r3"]: [analytics.top_states],
    }
    return {
        question.__name__: (lambda source=source, question=question: question(source()))
        for source, group in by_source.items()
        for question in group
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, memory=os.environ.get("BENCH_MEMORY", "12g"))
    root = tempfile.mkdtemp(prefix="bench-warehouse-")
    seconds: dict[str, float] = {}

    def timed(name, work) -> None:
        started = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - started, 3)

    timed("first_load", lambda: run_load(spark, root, mapping.earlier_sources(spark, folder)))
    timed("incremental_load", lambda: run_load(spark, root, mapping.sources(spark, folder)))
    timed("unchanged_load", lambda: run_load(spark, root, mapping.sources(spark, folder)))
    core = core_tables(spark, root)
    reports = load_queries.reports(core)
    for name, report in reports.items():
        timed(name, lambda report=report: run_all(report()))
    for name, question in questions(reports).items():
        timed(name, lambda question=question: run_all(question()))
    timed(
        "l1_features",
        lambda: run_all(
            late_delivery_features(
                core["fact_orders"], core["fact_order_items"], core["dim_date"], core["dim_customer"],
                core["dim_product"], core["dim_seller"],
            )
        ),
    )
    timed("model_run", lambda: run_late_model(spark, root))
    timed("r1_from_given_tables", lambda: run_all(report_queries.monthly(spark, folder)))
    timed("r2_from_given_tables", lambda: run_all(report_queries.categories(spark, folder)))
    timed("r3_from_given_tables", lambda: run_all(report_queries.states(spark, folder)))
    timed("l1_from_given_tables", lambda: run_all(risk_queries.feature_table(spark, folder)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "cpus": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
