"""Every registered query."""
from placeloom.plans import registry
from placeloom.plans import q_aggregate, q_audit, q_classify, q_derive, q_geometry, q_graph, q_joins, q_raster, q_resolve, q_select, q_sources, q_stream  # noqa: F401  (importing a module registers its queries)

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
