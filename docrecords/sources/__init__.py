"""Reading from and writing to files and tables."""
