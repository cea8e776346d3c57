"""DataFrame operators: deduplication, upserts, curation, clustering, parsing, reports."""
