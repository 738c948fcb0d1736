"""tidemark: classification-model lifecycle analytics as Spark DataFrame operators."""
