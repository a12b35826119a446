"""farelake: taxi-trip analytics as Spark DataFrame operators."""
