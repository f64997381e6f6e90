"""A star-schema ETL and analytics engine on Spark DataFrames."""
