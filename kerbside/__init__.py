"""Transit reports on Spark DataFrames: on-time performance of scheduled trips and changes between route plans."""
