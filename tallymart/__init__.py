"""Contract-driven retail marts, history and reconciliation as Spark DataFrame operators."""
