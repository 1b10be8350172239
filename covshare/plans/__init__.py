"""Plans: the county report, the query catalogue and its oracle."""
