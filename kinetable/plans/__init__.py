"""Plan shapes shared by the operators: skew handling, ordered passes, exact quantiles."""
