"""Agency performance analytics as lazy Spark DataFrame transformations."""
