"""Query-workload analytics on Spark."""
