"""Content-similarity analytics expressed as Spark DataFrame plans."""
