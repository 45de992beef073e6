"""Column-level helpers (JVM-side expressions) and the one vectorised UDF."""
