"""Writers for topics, files, keyed tables and dictionaries."""
