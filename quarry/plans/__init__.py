"""Query registry: Spark plans (``queries.QUERIES``) and DuckDB oracles (``oracles.ORACLES``)."""
