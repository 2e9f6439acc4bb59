"""Reading and writing tables, reports and the request log."""
