"""DataFrame operators: extract chain, per-key reduction, run sums, statistics."""
