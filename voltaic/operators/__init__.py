"""DataFrame -> DataFrame operators (no actions): dedup, merges, scoring, marts, quality."""
