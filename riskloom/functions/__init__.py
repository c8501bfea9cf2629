"""Column-level helpers: row-wise arithmetic, binning, rounding, tail probabilities."""
