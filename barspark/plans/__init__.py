"""Job plans: the ETL that builds the bar/feature tables, the query registry, oracles."""
