"""Reading and writing: raw CSV files, typed staging tables, published warehouse versions."""
