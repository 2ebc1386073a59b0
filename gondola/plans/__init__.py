"""All named queries, by theme."""

from gondola.plans import (  # noqa: F401
    basics,
    baskets,
    customers,
    enrich,
    fusion,
    incentives,
    outreach,
    quality,
    sources,
    standardise,
    stores,
    streaming,
    vectors,
)
from gondola.plans.registry import ORACLES, QUERIES  # noqa: F401
