"""trainlake sources."""
