"""Service-request quality and analytics expressed as Spark DataFrame plans."""
