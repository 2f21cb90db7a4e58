"""DataFrame transformations: filters, enrichment, metrics, key sets, cohorts, merges."""
