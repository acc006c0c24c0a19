"""chartloom: clinical cohorts and reporting datasets as Spark DataFrames."""
