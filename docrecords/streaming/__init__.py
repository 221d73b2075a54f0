"""The batch operators as incremental streams."""
