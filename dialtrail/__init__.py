"""Lead and call-log analytics as lazy PySpark DataFrame operators."""
