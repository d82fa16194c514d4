"""prepmill: from a raw table to a checked model, as lazy Spark DataFrame work."""
