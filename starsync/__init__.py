"""Two-way table reconciliation on Spark: capture, compare, resolve, replay."""
