"""tillstream: real-time retail analytics as Spark DataFrames and streams."""
