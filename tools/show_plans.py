"""Print the physical plans of the headline operators (markdown), used to
write PLANS.md. Usage: python tools/show_plans.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _backfill_rows(spark, sf):
    from pyspark.sql import functions as F

    from periodica.functions.periods import MONTHLY, period_start
    from periodica.operators.conformance import conform, violation_reason
    from periodica.plans import testdata as td
    spec = td.lineitem_spec(MONTHLY)
    landing = td.lineitem_landing(spark, sf)
    cols = [c for c in spec.stored_columns]
    rows = landing.select(F.col("ID"), *conform(cols), F.col("FECHA_EXTRACCION"),
                          violation_reason(cols).alias("_reason"))
    return rows.withColumn("period_start", period_start("l_shipdate", MONTHLY)) \
        .hint("rebalance", "period_start")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from periodica.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    from pyspark.sql import functions as F

    from periodica.functions.periods import MONTHLY, window_for
    from periodica.operators.joins import catalog_violations, orphan_keys
    from periodica.operators.quality import quality_scan
    from periodica.plans import reports
    from periodica.plans import testdata as td
    from periodica.plans.registry import scratch_lake
    from periodica.plans.reports import load_rows

    day = dt.date(1995, 3, 15)
    lake = scratch_lake(spark)
    spec = td.orders_spec(MONTHLY)
    reports.backfill(spark, lake, spec, td.orders_landing(spark, sf))
    sorted_spec = td.orders_spec(MONTHLY, sort=("o_orderdate", "o_orderkey"))
    cat = spark.createDataFrame([(k,) for k in ["1-URGENT", "2-HIGH"]], "key string")
    plans = [
        ("Delivery of one monthly window (D*)", reports.deliver(spark, lake, spec, day),
         "one partition read (PartitionFilters), the range pushed to Parquet (PushedFilters), "
         "one codegen stage, no exchange"),
        ("Ordered delivery (D212/D213 shape)",
         reports.deliver(spark, lake, sorted_spec.with_version(name=spec.name), day),
         "the only exchange is the range partitioning of the sort, with ID as tie-breaker"),
        ("Rows of a window load from landing (L*)",
         load_rows(spec, td.orders_landing(spark, sf), window_for(day, MONTHLY), day),
         "pushed range on the control date, conversion and violation reason in one projection"),
        ("Orphan keys (J3/V8)",
         orphan_keys(td.table(spark, sf, "orders"), "o_orderkey", td.table(spark, sf, "lineitem"),
                     "l_orderkey"),
         "both sides reduced to distinct keys by partial aggregation before their exchange; "
         "the join reuses that partitioning"),
        ("Catalog violations (J5/V7)",
         catalog_violations(td.table(spark, sf, "orders"), "o_orderpriority",
                            F.broadcast(cat), "901_ORDERS"),
         "broadcast catalog (size checked by the operator), partial counts per value"),
        ("Quality scan (V1/V2)", quality_scan(td.table(spark, sf, "lineitem"),
                                               td.lineitem_spec(strict=True).columns),
         "one global aggregation: every counter is a partial sum per task"),
        ("Backfill staging (S14, many windows)", _backfill_rows(spark, sf),
         "conversion and checks in one projection, then one rebalance exchange by "
         "period_start (AQE splits a large window, packs small ones) before the write"),
    ]
    print("# Physical plans of the headline operators\n")
    print(f"Generated by `tools/show_plans.py` on `{sf}` (local[8], broadcast threshold off so "
          "the join shapes are the ones a large input gets).\n")
    for title, df, note in plans:
        print(f"## {title}\n\n{note}.\n\n```")
        print(df._jdf.queryExecution().executedPlan().toString().strip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
