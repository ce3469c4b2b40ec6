"""Trip-record lakehouse jobs on Spark: Bronze, Silver, Gold, serving, quality."""
