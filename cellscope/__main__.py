"""Run a job: ``python -m cellscope <job> --help``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import (
    FOREST_DEPTH,
    FOREST_FOLDS,
    FOREST_TREES,
    SWEEP_KS,
    CleanRules,
)
from .operators.reliability import SELECT_BY
from .plans import jobs
from .plans.preprocess import preprocess_csv


def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _labels(path: str) -> dict[int, str]:
    """A JSON object of cluster number and label."""
    return {int(code): label for code, label in _file(path).items()}


def _rules(path: str) -> CleanRules:
    """A JSON object with the fields of CleanRules that differ from the default."""
    return CleanRules(**{
        name: tuple(value) if isinstance(value, list) else value for name, value in _file(path).items()})


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellscope", description="Cell-tower analytics on Spark")
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, *required: str, optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        made = commands.add_parser(name)
        for option in required:
            made.add_argument(f"--{option}", required=True)
        for option in optional:
            made.add_argument(f"--{option}")
        return made

    def training(made: argparse.ArgumentParser) -> argparse.ArgumentParser:
        made.add_argument("--partitions", type=int, required=True, help="of the training rows, some 100,000 in each")
        made.add_argument("--parallelism", type=int, default=2)
        return made

    made = command("preprocess", "source", "table", optional=("funnel", "quarantine"))
    made.add_argument("--partition-by", nargs="*", default=[])
    made.add_argument("--rules", type=_rules, default=CleanRules(), help="JSON file")
    command("reports", "clean", "root", optional=("cells", "batch"))
    for name in ("zones", "reliability"):
        made = training(command(name, "clean", "table", "root", optional=("model", "metrics", "run-id")))
        made.add_argument("--buckets", type=int, help="of the output, by tower; the same for both models")
        made.add_argument("--ks", nargs="+", type=int, default=list(SWEEP_KS))
        if name == "reliability":
            made.add_argument("--select-by", choices=SELECT_BY, default=SELECT_BY[0])
    made = training(command("classifier", "zone-table", "reliability-table", "root", optional=("model", "metrics", "run-id")))
    made.add_argument("--trees", nargs="+", type=int, default=[FOREST_TREES])
    made.add_argument("--depths", nargs="+", type=int, default=[FOREST_DEPTH])
    made.add_argument("--folds", type=int, default=FOREST_FOLDS)
    made = command("views", "report-root", "zone-root", "reliability-root", "classifier-root", "out")
    for name in ("zone", "reliability", "short"):
        made.add_argument(f"--{name}-labels", type=_labels, help="JSON file")
    made.add_argument("--headings", type=_file, help="JSON file")
    made = command("slice", "reliability-root", "out", optional=("country",))
    made.add_argument("--cluster", type=int)
    return top


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    run = {
        "preprocess": preprocess_csv,
        "reports": jobs.run_reports,
        "zones": jobs.run_zones,
        "reliability": jobs.run_reliability,
        "classifier": jobs.run_classifier,
        "views": jobs.run_views,
        "slice": jobs.run_slice,
    }[options.pop("job")]
    spark = SparkSession.builder.appName("cellscope").getOrCreate()
    run(spark, **options)


if __name__ == "__main__":
    main()
