"""Card-payment analytics as Spark DataFrame jobs."""
