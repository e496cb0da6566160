"""DataFrame to DataFrame steps: joins, changes, reductions and constraint checks."""
