"""Source-code dependency analytics on Spark."""
