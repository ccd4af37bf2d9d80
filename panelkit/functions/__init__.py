"""Column-level helpers: every function returns a ``Column`` built from Spark
SQL expressions (JVM-side, inside whole-stage codegen)."""
