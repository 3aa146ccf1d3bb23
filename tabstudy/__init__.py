"""Table studies on Spark: profile, split, rebalance, prepare, fit, compare."""
