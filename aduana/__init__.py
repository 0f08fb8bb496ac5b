"""aduana: foreign-trade and company-register analytics as plain Spark DataFrame operators."""
