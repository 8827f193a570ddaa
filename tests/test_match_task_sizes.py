"""Queries on the match cascade size their tasks to the given tables."""

import os

import pytest

import __spark_entry__ as entry

NAMES = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.mark.parametrize("key", ["match_totals", "quality_flag_row", "unmatched_breakdown"])
def test_matching_gets_more_tasks(spark, tmp_path, key):
    keep = {k: spark.conf.get(k) for k in NAMES}
    try:
        for name in os.listdir(entry.SMOKE_DIR):
            if name != "benchmark.parquet":
                (tmp_path / name).symlink_to(f"{entry.SMOKE_DIR}/{name}")
        # A table that matching does not read stands for the size of the whole.
        (tmp_path / "benchmark.parquet").write_bytes(bytes(80 << 20))
        entry.queries()[key](spark, str(tmp_path))
        assert int(spark.conf.get(NAMES[0])) >= 20
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
