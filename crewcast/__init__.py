"""Service-demand analytics as Spark DataFrame transformations."""
