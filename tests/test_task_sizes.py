"""Tasks stay small as tables grow."""

from concordat.session import TASK_BYTES, fit_tasks

NAMES = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_more_input_makes_more_tasks(spark, tmp_path):
    keep = {k: spark.conf.get(k) for k in NAMES}
    try:
        (tmp_path / "a.parquet").write_bytes(bytes(20 * TASK_BYTES))
        paths = [str(tmp_path / "a.parquet"), str(tmp_path / "missing.parquet")]
        fit_tasks(spark, paths)
        assert [spark.conf.get(k) for k in NAMES] == ["20", f"{TASK_BYTES}b", f"{2 * TASK_BYTES}b"]
        for k, v in zip(NAMES, ("50", "1m", "1m")):
            spark.conf.set(k, v)
        fit_tasks(spark, paths)
        assert [spark.conf.get(k) for k in NAMES] == ["50", "1m", "1m"]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
