"""All registered queries."""

from concordat.workload import (  # noqa: F401
    q_claims,
    q_matching,
    q_quality,
    q_scalars,
    q_state,
    q_supervision,
    q_tables,
)
from concordat.workload.registry import ORACLES, QUERIES  # noqa: F401
