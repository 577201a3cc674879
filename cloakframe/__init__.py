"""PII-safe queries, profiling and workload analytics as PySpark DataFrame functions."""
