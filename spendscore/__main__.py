"""Command line of the pipeline steps."""

from __future__ import annotations

import argparse
from datetime import date

from spendscore.config import PipelineConfig
from spendscore.operators.silver import month_labels
from spendscore.plans import pipeline


def month_range(text: str) -> list[str]:
    """Month labels from the first to the last of ``FROM:TO``."""
    first, last = (date.fromisoformat(f"{part}-01") for part in text.split(":"))
    return month_labels(first, last)


def main() -> None:
    parser = argparse.ArgumentParser(prog="spendscore", description="Run the spend score job.")
    parser.add_argument("settings", help="JSON settings file")
    parser.add_argument(
        "--step", choices=["all", "bronze", "silver", "gold", "reports"], default="all"
    )
    parser.add_argument("--as-of", type=date.fromisoformat, help="run date, today if left out")
    parser.add_argument(
        "--months", type=month_range, metavar="FROM:TO", help="store spend by these months, as 2024-01:2024-12"
    )
    parser.add_argument("--run", help="name of this load: started again, it adds nothing twice")
    parser.add_argument("--preview", action="store_true", help="print some rows of each result")
    args = parser.parse_args()

    config = PipelineConfig.from_json(args.settings)
    spark = pipeline.get_session()
    if args.step == "all":
        pipeline.run_pipeline(spark, config, args.as_of, months=args.months, preview=args.preview, run=args.run)
    elif args.step == "bronze":
        pipeline.run_bronze(spark, config, args.as_of, run=args.run)
    elif args.step == "silver":
        pipeline.run_silver(spark, config, months=args.months, preview=args.preview)
    elif args.step == "gold":
        pipeline.run_gold(spark, config, args.as_of, preview=args.preview, run=args.run)
    else:
        pipeline.run_reports(spark, config, args.as_of, preview=args.preview)


if __name__ == "__main__":
    main()
