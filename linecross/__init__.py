"""Find and classify the places where one line network crosses another, on Spark DataFrames."""
