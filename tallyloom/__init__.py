"""tallyloom: cohort tables, spatial tables and training corpora as Spark DataFrames."""
