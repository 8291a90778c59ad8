"""Print the physical plan of the headline reports as Spark would plan them
at scale (static broadcasts off, so every join shows its shuffle), with a
count of exchanges per plan.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimsflow.catalog import QUERIES  # noqa: E402
from claimsflow.session import local_session  # noqa: E402

KEYS = ("rep000_combined_extract", "rep012_original_values", "rep013_monthly_matrix",
        "recon_health_report", "change_apply")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for key in KEYS[:-1]:
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = [re.sub(r"#\d+", "", ln)[:160] for ln in plan.splitlines()
                 if re.search(r"Exchange|Join|Window|Aggregate|Scan|Sort \[|Expand|Generate", ln)]
        print(f"== {key}: {plan.count('Exchange ')} exchanges")
        print("\n".join(lines))
        print()


if __name__ == "__main__":
    main()
