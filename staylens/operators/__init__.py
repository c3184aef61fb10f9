"""DataFrame operators: schema enforcement, de-duplication, history, quantiles, skew, profiling."""
