"""Reading landed files, tables and shards."""
