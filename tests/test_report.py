"""The published document and the series read from it."""

from pyspark.sql import functions as F

from concordat.plans import report as rp
from concordat.plans import supervision as sv
from concordat.workload.q_supervision import report
from concordat.workload.registry import Frames


def test_series_find_every_indicator_in_the_document(spark):
    facts = report(Frames(spark, "/root/testdata/sf0.001"))
    history = rp.to_document(facts).select(F.lit("31122001").alias("flux_id"), F.lit(None).cast("timestamp_ntz").alias("date_import"), "payload")
    found = {r["kpi"]: r["value"] for r in sv.kpi_series(history).collect()}
    assert set(found) == set(sv.KPI_PATHS) and None not in found.values()
    assert set(rp.HIGHLIGHTS.values()) <= {tuple(r)[:4] for r in facts.collect()}
