"""Column-level functions: missing-value rules and key handling."""
