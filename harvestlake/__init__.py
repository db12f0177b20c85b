"""Research-dataset catalog jobs on Spark."""
