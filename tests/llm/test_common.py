"""Helpers that several training-data operators share."""

import os
import subprocess
import sys
from pathlib import Path

from candlewright.llm.common import flagged


def test_flagged_numbers_with_gaps(spark):
    numbers = [part << 33 | i for part in (0, 1, 5) for i in (0, 1, 7, 8, 9, 32767, 32768, 32769, 65536, 70001)]
    chosen = [*numbers[::3], numbers[0]]
    rows = spark.createDataFrame([(n, "x") for n in numbers], "at long, other string").repartition(3)
    found = flagged(rows, "at", spark.createDataFrame([(n,) for n in chosen], "n long"), "is_in")
    assert found.columns == ["at", "other", "is_in"]
    assert {(r["at"], r["is_in"]) for r in found.collect()} == {(n, n in chosen) for n in numbers}
    assert flagged(rows, "at", rows.select("at").limit(0), "is_in").where("is_in").count() == 0


def test_a_worker_gives_back_what_a_stage_has_freed():
    """Over 8 MB of texts the worker kept 185 MB after the quality stage before; the vocabularies stay, 106 MB in all."""
    root = Path(__file__).parents[2]
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(root), os.environ.get("PYTHONPATH", "")])}
    told = subprocess.run([sys.executable, "-m", "tests.llm.worker_memory", "quality"], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert told.returncode == 0, told.stderr[-2000:]
    assert int(told.stdout.split()[-1]) < 145
