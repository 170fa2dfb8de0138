"""shoplens: e-commerce behaviour analytics on Spark DataFrames and streams."""
