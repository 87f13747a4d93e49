"""Order and inventory analytics as Spark DataFrame and streaming operators."""
