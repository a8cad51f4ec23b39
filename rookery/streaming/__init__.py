"""Event streams: contract checks, deduplication, lateness, windows, jobs."""
