"""Named queries, the daily batch and the query registry."""
