"""All registered queries."""

from poolwright.workload import basics, enrichment, roundtrips, selection  # noqa: F401
from poolwright.workload.registry import QUERIES  # noqa: F401
