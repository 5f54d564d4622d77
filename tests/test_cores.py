"""Models do not depend on the cores of the session."""

import json
import os
import subprocess
import sys

import pytest

from cellscope.registry import queries
from cellscope.sources import write_table

from tests.conftest import ROOT, TABLES

FIT = """
import json, sys
from cellscope.operators import classify, reliability, zones
from cellscope.session import local_session

spark = local_session(int(sys.argv[2]), folder=sys.argv[3])
rows = spark.read.parquet(sys.argv[1])
sweep = zones.kmeans_sweep(rows, [3], partitions=4, fraction=0.5)
mixture = reliability.gmm_sweep(rows, [2], partitions=4)
forest = classify.fit_forest(classify.rf_features(rows), trees=5, depth=4, partitions=4)
numbers = [*sweep.metrics.first()[1:3], *mixture.metrics.first()[1:4], *forest.featureImportances.toArray()]
print("NUMBERS", json.dumps([float(x) for x in numbers]))
"""


def test_metrics_are_equal_on_two_and_on_four_cores(spark, tmp_path):
    rows = queries.in_clusters(queries.unit_space(queries.encoded(spark, f"{TABLES}/sf0.001")))
    write_table(rows.withColumn("prediction", rows["gmm_cluster"]).repartition(3), str(tmp_path / "rows"))
    found = []
    for cores in ("2", "4"):
        run = subprocess.run(
            [sys.executable, "-c", FIT, str(tmp_path / "rows"), cores, str(tmp_path / f"shared{cores}")],
            capture_output=True, text=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, timeout=600)
        line = next((x for x in run.stdout.splitlines() if x.startswith("NUMBERS")), None)
        assert line, run.stderr[-2000:]
        found.append(json.loads(line.removeprefix("NUMBERS ")))
    assert found[0] == pytest.approx(found[1], rel=1e-9)
