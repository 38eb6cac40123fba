"""All registered queries."""

from __future__ import annotations

from riskstream.plans import archive, features, keys, quality, reference
from riskstream.plans.inputs import Query

QUERIES: dict[str, Query] = {
    **features.QUERIES,
    **archive.QUERIES,
    **keys.QUERIES,
    **reference.QUERIES,
    **quality.QUERIES,
}
