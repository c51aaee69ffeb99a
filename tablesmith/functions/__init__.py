"""Column-expression helpers, bin rules and driver-side distributions."""
