"""The registered queries over the Parquet test tables, and the same questions in SQL."""
