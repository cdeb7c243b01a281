"""Fixed parameters and column-level helper expressions."""
