"""rowgate: apply change requests to tables at scale with Spark DataFrames and streams."""
