"""DataFrame-in, DataFrame-out operators (no actions except bounded size checks)."""
