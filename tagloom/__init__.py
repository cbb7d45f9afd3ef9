"""XML data engine on PySpark DataFrames."""
