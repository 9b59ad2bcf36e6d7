"""Finance-content ETL and digest operators on PySpark DataFrames."""
