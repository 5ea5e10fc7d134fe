"""trainlake streaming."""
