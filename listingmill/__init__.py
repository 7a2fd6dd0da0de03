"""Property-listing cleaning, exploration and price modelling on Spark DataFrames."""
