"""Reading and writing: delimited files and snapshot tables."""
