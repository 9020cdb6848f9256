"""Trail analytics as Spark DataFrame operators."""
