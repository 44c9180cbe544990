"""Reading tables, lookups and paged extracts."""
