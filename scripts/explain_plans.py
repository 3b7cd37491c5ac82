"""Write the formatted physical plan of registered queries to a folder for review.

    python scripts/explain_plans.py OUT_DIR [--sf DIR] [name ...]

Plans are taken after execution (``noop`` sink), so with AQE they show the final plan: broadcast
choices from measured sizes, coalesced partitions and skew splits.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from firstbasket.plans.catalog import REGISTRY  # noqa: E402
from firstbasket.session import local_session  # noqa: E402

DEFAULT = ("abt", "reorder_label", "first_order_spine", "dominant_category", "payment_features",
           "review_dedup", "label_correlation", "score_deciles", "roc_auc", "stratified_split")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("out")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    os.makedirs(args.out, exist_ok=True)
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for name in args.names or DEFAULT:
        df = REGISTRY[name](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        with open(os.path.join(args.out, f"{name}.txt"), "w") as fh:
            fh.write(plan)
        print(name, "->", os.path.join(args.out, f"{name}.txt"))


if __name__ == "__main__":
    main()
