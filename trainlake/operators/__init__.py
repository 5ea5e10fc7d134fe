"""trainlake operators."""
