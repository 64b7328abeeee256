"""Order prediction data work as Spark DataFrame operators."""
