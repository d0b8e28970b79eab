"""Review landing on Spark: load, normalise, check, route, land and record."""
