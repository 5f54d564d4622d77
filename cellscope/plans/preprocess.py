"""From raw towers to the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, CleanRules
from ..operators.encoding import encode_towers
from ..operators.features import enrich
from ..operators.quality import clean_towers, cleaned_with_steps, funnel_of, quality_steps
from ..sources import CLEAN_COLUMNS, read_towers_csv, staged_table, write_report, write_table
from ..sources.csv_towers import CORRUPT_COLUMN


def preprocess(raw: DataFrame, rules: CleanRules = DEFAULT_RULES) -> DataFrame:
    """Clean, enrich and encode: the 29 columns of the clean table.

    Fitting scans ``raw`` once; the result is a narrow projection of it.
    Identity features are left out: their ``unit`` may be null and the clean
    table does not hold them (see ``identity_features``).
    """
    rows = enrich(clean_towers(raw, rules), rules)
    return encode_towers(rows).select(*CLEAN_COLUMNS)


def preprocess_csv(
    spark: SparkSession, source: str, table: str, funnel: str | None = None,
    partition_by: tuple[str, ...] = (), rules: CleanRules = DEFAULT_RULES, quarantine: str | None = None,
) -> None:
    """CSV files to the clean Parquet table, and the quality funnel if asked.

    ``quarantine`` gets the malformed rows, as the text they have in the files (Parquet, one
    column); the funnel then begins before they are dropped and has a step for them.

    The text is parsed once and every predicate evaluated once: staged in the
    shared folder are the cleaned rows and, for the funnel, the number of the
    step at which each other row fails.  Fitting and writing then read Parquet;
    the staged table is gone when the job ends.
    """
    raw = read_towers_csv(spark, source, on_bad="keep" if quarantine else "drop")
    names = [name for name, _ in quality_steps(raw, rules)]
    in_steps = funnel or quarantine
    # the passing rows, the malformed ones and the others lie in folders of their own
    kind = F.when(F.col("failed_at") == len(names) + 1, "clean").when(
        (F.col("failed_at") == 1) if quarantine else F.lit(False), "malformed").otherwise("failed")
    made = cleaned_with_steps(raw, rules).withColumn("kind", kind) if in_steps else clean_towers(raw, rules)
    with staged_table(made, "clean", ["kind"] if in_steps else ()) as staged:
        if funnel:
            write_report(funnel_of(staged.select("failed_at"), names), funnel)
        if quarantine:
            write_table(staged.filter("kind = 'malformed'").select(F.col(CORRUPT_COLUMN).alias("row")), quarantine)
        if in_steps:
            staged = staged.filter("kind = 'clean'").drop("failed_at", "kind", CORRUPT_COLUMN)
        rows = enrich(staged, rules)
        write_table(encode_towers(rows).select(*CLEAN_COLUMNS), table, partition_by)
