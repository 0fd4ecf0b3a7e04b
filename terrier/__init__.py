"""Housing-data preparation expressed as Spark DataFrame operators."""
