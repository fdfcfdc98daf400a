"""cartlens: commerce analytics as Spark DataFrame operators."""
