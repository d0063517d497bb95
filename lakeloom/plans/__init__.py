"""Layer updates: read, transform, write, and return the new high-water mark."""
