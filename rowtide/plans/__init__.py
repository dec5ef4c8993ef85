"""Plans: fixtures derived from the driver tables, end-to-end pipelines and the query registry."""
