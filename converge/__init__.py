"""Change-data convergence on Spark: normalise, fold, search, evaluate and reconcile, all as DataFrame plans."""
