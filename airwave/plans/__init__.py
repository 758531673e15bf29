"""Jobs over files, and the registered queries with their SQL checks."""
