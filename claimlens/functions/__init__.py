"""Column-expression builders (all JVM-side, no Python UDFs)."""
