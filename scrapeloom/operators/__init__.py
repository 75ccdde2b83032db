"""DataFrame operators: cleaning, profiling, quality gates, resolution."""
