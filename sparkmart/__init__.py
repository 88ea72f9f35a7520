"""Customer, credit, marketing and inventory analytics as lazy Spark DataFrame operators."""
