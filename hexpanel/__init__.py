"""hexpanel: a Spark-first analytics engine for yearly land-registry panels."""
