"""Column-expression helpers; each returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage code generation."""
