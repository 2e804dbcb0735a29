"""Write the physical plans of the headline queries to docs/PLANS.md.

For each query: the physical plan tree and, for every scan, its pushed
filters and read schema.

Usage: python scripts/explain_headline.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from stratum.queries import QUERIES  # noqa: E402
from stratum.session import local_session  # noqa: E402


AT_SCALE = ("monthly_sales_hot_keys", "dedup_latest_hot_keys")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session("stratum-plans", checkpoint_dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
                          extra_conf={"spark.sql.shuffle.partitions": "16"})
    out = [f"# Physical plans of the headline queries\n\nInput: `{base}`, local[8], AQE on, after one execution "
           "(final adaptive plans). Generated by `scripts/explain_headline.py`.\n"]
    for name in HEADLINE:
        df = QUERIES[name](spark, base)
        df.write.format("noop").mode("overwrite").save()
        text = formatted(df)
        tree = text.split("\n\n")[0]
        details = [line for line in text.splitlines()
                   if line.startswith(("Location:", "PushedFilters:", "ReadSchema:", "PartitionFilters:"))]
        out.append(f"## {name}\n\n```\n{tree.strip()}\n\n" + "\n".join(details) + "\n```\n")
    # the plan a dimension beyond every broadcast bound gets, with hot keys
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in AT_SCALE:
        df = QUERIES[name](spark, base)
        df.write.format("noop").mode("overwrite").save()
        tree = formatted(df).split("\n\n")[0]
        out.append(f"## {name} (automatic broadcast off, as for dimensions beyond the bound)\n\n"
                   f"```\n{tree.strip()}\n```\n")
    spark.stop()
    os.makedirs(f"{ROOT}/docs", exist_ok=True)
    with open(f"{ROOT}/docs/PLANS.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
