"""Column-expression library: every helper returns a native ``Column``."""
