import glob

import pytest
from conftest import SF

from tallybrook.plans import catalog


@pytest.mark.parametrize("name", ["pipeline_stream", "stream_without_copies", "live_revenue"])
def test_stream_sources_spread_over_the_shuffle_partitions(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(catalog, "run_folder", lambda spark: str(tmp_path))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        catalog.QUERIES[name](spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = glob.glob(f"{tmp_path}/{'stored' if name == 'live_revenue' else 'log'}/part-*")
    batches = glob.glob(f"{tmp_path}/checkpoint/commits/[0-9]*")
    assert 4 < len(files) <= 9 and 1 < len(batches) < len(files)
