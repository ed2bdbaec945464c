"""Order analytics and dissatisfaction risk as Spark DataFrame operators."""
