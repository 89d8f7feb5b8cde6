"""Reading and writing graphs stored as chunked columnar files."""
