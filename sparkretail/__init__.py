"""Retail, card-payment and clickstream analytics as plain Spark DataFrame operators."""
