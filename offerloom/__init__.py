"""offerloom: matching shop offers to catalogue products on Spark, and judging how well it works."""
