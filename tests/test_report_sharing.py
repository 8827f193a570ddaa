"""Queries on the report do the work that several blocks need once, and no work of blocks that they do not read."""

import os

import pytest

import __spark_entry__ as entry
from concordat.plans import report as rp
from concordat.workload import q_claims, q_matching, q_quality
from concordat.workload.registry import Frames


@pytest.fixture
def asked(monkeypatch):
    """Names of the results in the order they are made."""
    names = []

    def counted(name, fn):
        return lambda f: names.append(name) or fn(f)

    for b in {b.result for b in rp.BLOCKS}:
        for module in (q_quality, q_matching, q_claims):
            if hasattr(module, b):
                monkeypatch.setattr(module, b, counted(b, getattr(module, b)))
    return names


def test_blocks_read_written_contracts(spark):
    from concordat.workload.q_supervision import results

    made = results(Frames(spark, entry.SMOKE_DIR))
    for name in ("volume_raw", "match_by_segment", "quality_score", "card_kpis", "card_registry_correlation", "lines_vs_persons", "document_kpis"):
        tables = {part for path in made[name].inputFiles() for part in path.split(os.sep)}
        assert not tables & {"orders.parquet", "lineitem.parquet"}, name


def test_report_makes_each_result_once(spark, asked):
    entry.queries()["kpi_report"](spark, entry.SMOKE_DIR)
    assert sorted(asked) == sorted({b.result for b in rp.BLOCKS})


def test_thematic_makes_each_result_once(spark, asked):
    entry.queries()["kpi_thematic"](spark, entry.SMOKE_DIR)
    assert sorted(asked) == sorted({b.result for b in rp.BLOCKS})


def test_anomalies_make_only_their_blocks(spark, asked):
    assert entry.queries()["quality_anomalies"](spark, entry.SMOKE_DIR).count() > 0
    assert sorted(asked) == ["account_quality", "quality_score", "registry_presence_by_type"]


def test_detail_makes_only_its_block(spark, asked):
    assert entry.queries()["kpi_detail"](spark, entry.SMOKE_DIR).count() > 0
    assert asked == ["match_by_segment"]
