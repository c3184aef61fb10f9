"""staylens: short-term-rental marketplace analytics as Spark DataFrame operators."""
