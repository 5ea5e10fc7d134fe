"""trainlake: a PySpark engine for preparing and querying conversational training data."""
