"""The report's plan stays small on the driver, whatever the number of blocks."""

from concordat.workload.q_supervision import report
from concordat.workload.registry import Frames


def test_the_report_is_read_from_one_folder(spark):
    facts = report(Frames(spark, "/root/testdata/sf0.001"))
    plan = facts._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1
    assert facts.select("section").distinct().count() > 5
