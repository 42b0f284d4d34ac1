"""Back-office document processing expressed as Spark DataFrame operators."""
