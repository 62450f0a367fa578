"""foliospark: document-ML data processing on PySpark DataFrames."""
