"""Distribution strategies shared by the operators: size-checked lookups and skew-free ranks."""
