"""Print the formatted physical plans of the heavy operators (for scale reviews).

usage: python tools/show_plans.py [sf_dir] [--no-broadcast]

``--no-broadcast`` disables automatic broadcast joins, showing the plans a large
input would get (sort-merge joins instead of the broadcasts small fixtures allow).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession

    from riskflow.operators.asof import asof_join
    from riskflow.plans import features as fe
    from riskflow.sources.fixtures import AS_OF, load_fixture

    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    b = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    if "--no-broadcast" in sys.argv:
        b = b.config("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tx, lb = load_fixture(spark, sf_dir)
    cust = fe.customer_per_second(tx, lb, AS_OF)
    plans = {
        "customer features (per second)": cust,
        "customer feature view": fe.customer_features(tx, lb, AS_OF),
        "terminal features (per second)": fe.terminal_per_second(tx, lb, AS_OF),
        "as-of join": asof_join(tx, cust.drop("n_tx"), "CUSTOMER_ID", "TX_TS", "customer_id", "feature_ts",
                                right_unique=True),
    }
    for name, df in plans.items():
        print(f"===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
