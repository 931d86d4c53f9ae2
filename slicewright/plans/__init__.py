"""Plans: per-report pipelines, load/backfill/audit jobs, the named query
catalog and its oracle SQL."""
