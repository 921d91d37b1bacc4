"""strandloom: strain-level comparison analytics expressed as Spark DataFrame plans."""
