"""Post discovery on Spark: collect, match, normalise, de-duplicate, append, report."""
