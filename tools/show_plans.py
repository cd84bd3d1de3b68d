"""Write docs/PLANS.md: physical plan trees of key queries (explain "formatted").

usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import registry  # noqa: E402
from tallyrisk.session import build_session, shared_dir  # noqa: E402

KEYS = ["H06_gold_fraud_features", "H02_silver_customers", "H04_silver_transactions",
        "H09_customer_risk_dashboard", "D10_kpi_cards", "E08_E15_velocity_real", "Q06_foreign_key_orphans"]


def bucketed_section(spark, sf_dir: str) -> list[str]:
    """Feature plan over silver transactions published bucketed on (customer, day)."""

    from tallyrisk.plans import gold, runs
    from tallyrisk.sources.fixtures import bronze_frames
    from tallyrisk.sources.raw_files import with_lineage
    from tallyrisk.sources.store import LayerStore


    store = LayerStore(spark, f"{shared_dir(spark)}/plans-store-{os.getpid()}")
    for table, build in bronze_frames(spark, sf_dir).items():
        with_lineage(build(), batch_id="plans", source_file=table).write.mode("overwrite").parquet(
            runs.bronze_path(store, table))
    runs.run_silver(spark, store, registry.AS_OF, version="v1", buckets=16)
    df = gold.fraud_features(store.read("silver_transactions"), store.read("silver_accounts"), registry.AS_OF,
                             bucket_col=runs.DAY_BUCKET, prehashed=True)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    tree = buf.getvalue().split("\n\n")[0]
    return ["## H06 over bucketed silver transactions (`run_silver(buckets=16)`)", "",
            "The row path (scan, broadcast join with the summary, sort, window) has no exchange.", "",
            "```", tree.strip(), "```", ""]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on `{sf_dir}` (initial adaptive plans; AQE may still",
           "turn a sort-merge join into a broadcast join at run time). For each query: the operator",
           "tree, then every exchange's partitioning and every scan's pushed filters and read schema.", ""]
    for key in KEYS:
        df = registry.REGISTRY[key].build(registry.spark_layers(spark, sf_dir))
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        details = []
        for block in text.split("\n\n")[1:]:
            head = block.strip().splitlines()[0] if block.strip() else ""
            if re.match(r"\(\d+\) (Exchange|Scan parquet)", head):
                keep = [ln for ln in block.strip().splitlines()
                        if ln.startswith(("(", "Arguments", "PushedFilters", "ReadSchema"))]
                details.append("\n".join(keep))
        out += [f"## {key}", "", "```", tree.strip(), "```", "", "```", "\n\n".join(details), "```", ""]
    out += bucketed_section(spark, sf_dir)
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
