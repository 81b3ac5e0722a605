"""Bronze schemas, readers and table storage."""
