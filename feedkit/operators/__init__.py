"""Building blocks: mapping, relating, ranking, set operations, change detection, routing."""
