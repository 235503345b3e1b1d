"""Bronze, silver and gold layers for messy transaction records, on Spark."""
