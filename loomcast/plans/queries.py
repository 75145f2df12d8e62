"""All registered queries; importing the modules registers them."""

from loomcast.plans import (  # noqa: F401
    flagship,
    q_aggregates,
    q_joins,
    q_learning,
    q_lists,
    q_rows,
    q_scalars,
    q_scans,
    q_serving,
    q_streams,
    q_windows,
)
from loomcast.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
