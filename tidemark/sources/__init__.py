"""Schema documents, readers, writers and external sources."""
