"""Column-level building blocks (JVM-side expressions) and the UDF surface."""
