"""Reading and writing tables, feeds and other file formats."""
