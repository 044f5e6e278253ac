"""Reading and writing: schemas, files, partitioned layers, catalog tables."""
