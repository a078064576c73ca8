"""Named results: summaries, marts, the warehouse, checks and whole runs."""
