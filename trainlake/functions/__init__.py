"""trainlake functions."""
