"""Reading and writing: raw archives, export XML, silver and gold tables."""
