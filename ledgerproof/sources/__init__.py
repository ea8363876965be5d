"""Reading exports into all-text tables, checking them, and writing results."""
