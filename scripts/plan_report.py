"""Write PLANS.md: operator counts, scans (pushed filters, read columns) and
the physical plan tree of the headline queries, from explain("formatted").

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
The static plan (AQE off) is shown, i.e. what Catalyst picks before runtime
statistics; at sf0.1 the stored Parquet files are below the broadcast
threshold, so fact joins show as broadcast here and as sort-merge joins at
cluster scale.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.plans import registry  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

QUERIES = ["m12_int_sap_sales_by_store_date", "m13_int_pos_sap_matched", "m14_int_pay_bank_matched",
           "m19_mart_root_cause_trend", "k12_check_report", "o01_exception_log_order"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    registry.models(spark, sf_dir).raw.load_all()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Physical plans ({os.path.basename(sf_dir)}, static, AQE off)\n")
    print("Generated by `scripts/plan_report.py`.\n")
    for name in QUERIES:
        df = registry.QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        nodes = Counter(re.findall(r"^\(\d+\) (\w+(?: \w+)?)", plan, re.M))
        print(f"## {name}\n")
        print("Operators: " + ", ".join(f"{k} ×{v}" for k, v in sorted(nodes.items())) + "\n")
        print("| scan | pushed filters | columns read |\n| --- | --- | --- |")
        for m in re.finditer(r"\(\d+\) Scan parquet.*?\n(.*?)\n\n", plan, re.S):
            block = m.group(1)
            loc = re.search(r"Location: .*?\[(.*?)\]", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            cols = re.findall(r"(?:^|,)(\w+):", rs.group(1)) if rs else []
            print(f"| {loc.group(1).split('/')[-1] if loc else '?'} | {pf.group(1)[:160] if pf else ''} | "
                  f"{len(cols)}: {', '.join(cols)[:160]} |")
        tree = plan.split("\n\n")[0]
        print("\n```\n" + tree.strip() + "\n```\n")


if __name__ == "__main__":
    main()
