"""The raw CSV has the partitions of the scan, and two at least."""

from __future__ import annotations

import pytest

from skyfact.plans import roundtrips
from skyfact.sources import views

from conftest import SF


@pytest.mark.parametrize("parts", [1, 5])
def test_raw_files(spark, monkeypatch, parts):
    wide = views.obs_wide(spark, SF).limit(200).localCheckpoint().repartition(parts)
    monkeypatch.setattr(views, "obs_wide", lambda *_: wide)
    rows = spark.read.option("header", True).csv(roundtrips._raw_files(spark, SF))
    assert rows.count() == 200 and len(rows.inputFiles()) == max(parts, 2)
