"""DataFrame -> DataFrame operators: silver and gold models, fan-out
rollups, data-quality rules and monitoring queries."""
