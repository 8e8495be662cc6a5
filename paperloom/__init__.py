"""Paper-corpus preparation expressed as Spark DataFrame transformations."""
