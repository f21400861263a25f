"""Column-expression building blocks shared by all operators."""
