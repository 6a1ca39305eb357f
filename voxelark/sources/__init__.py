"""Reading and writing feature tables, studies and volumes."""
