"""All registered queries by name."""

from __future__ import annotations

from matchmill.plans.queries import frames, jobs, kpis, merges, payloads, workload
from matchmill.plans.queries.common import Query

REGISTRY: dict[str, Query] = {
    **kpis.QUERIES,
    **frames.QUERIES,
    **merges.QUERIES,
    **payloads.QUERIES,
    **workload.QUERIES,
    **jobs.QUERIES,
}
