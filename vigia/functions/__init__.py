"""Column-level helpers.  All built from ``pyspark.sql.functions`` (JVM side)."""
