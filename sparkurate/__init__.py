"""Dataset curation and evaluation on PySpark DataFrames."""
