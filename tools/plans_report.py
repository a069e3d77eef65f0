"""Print the physical operator trees of the main stages as Markdown (expressions elided).

Usage: python tools/plans_report.py <lake root written by bench.py or run_pipeline>
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in text.splitlines():
        line = re.sub(r"\[[^\[\]]{40,}\]", "[…]", line)
        line = re.sub(r"\([^()]{60,}\)", "(…)", line)
        line = re.sub(r"#\d+L?", "", line)
        out.append(line[:150])
    return "\n".join(out)


def main(root: str) -> None:
    from pubspark.operators.parse import bronze_with_status
    from pubspark.operators.silver import build_silver
    from pubspark.operators.validation import validation_report
    from pubspark.plans import analytics as A
    from pubspark.plans.batch import BRONZE, SILVER_TABLES, _sound, bronze_schema, read_silver, silver_schemas
    from pubspark.session import build_session
    from pubspark.sources.lake import live_runs, read_build
    from pubspark.sources.raw import ITEM, LANDED, as_items, read_landed_build

    spark = build_session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")

    # A batch reads its own builds back; readers of the lake go by the log (the last plan).
    def build(layer):
        return live_runs(spark, root, layer).first().build

    raw = as_items(read_landed_build(spark, root, build(f"{LANDED}/{ITEM}")).where(f"kind = '{ITEM}'"))
    bronze = _sound(read_build(spark, root, BRONZE, build(BRONZE), bronze_schema()))
    silver = build_silver(bronze, "2025-01-01", by=("run", "day"))
    schemas = silver_schemas(spark)
    t = {n: read_build(spark, root, f"silver/{n}", build(f"silver/{n}"), schemas[n]) for n in SILVER_TABLES}
    runs = t["publications"].select("run", "day").distinct()
    stages = {
        "bronze (parse)": bronze_with_status(raw, keep=("source_file", "run", "day")),
        "silver publications (top-1 per run, DOI)": silver["publications"],
        "silver authors": silver["publication_authors"],
        "silver identifiers": silver["identifiers"],
        "silver quality issues": silver["quality_issues"],
        "validation report (per run)": validation_report(
            t["publications"], t["publication_authors"], t["identifiers"], t["quality_issues"],
            by=("run", "day"), groups=runs),
        "Q1 author publication stats": A.author_publication_stats(spark, t["publication_authors"]),
        "Q2 publisher x type": A.publisher_type_summary(spark, t["publications"]),
        "Q3 quality issue summary": A.quality_issue_summary(spark, t["quality_issues"]),
        "A reader: publications of all runs, by the log": read_silver(spark, root, "publications", None),
        "A reader: publications of the latest run": read_silver(spark, root, "publications", "latest"),
    }
    print("# Physical plans of the main stages\n")
    print("Generated by `tools/plans_report.py` over the layers written by `bench.py` at sf0.1 "
          "(local[8], 16 shuffle partitions). Long expression lists are elided as `[…]`; "
          "plans are shown before adaptive execution re-plans them at run time.\n")
    for name, df in stages.items():
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
