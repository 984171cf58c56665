"""Statement folders that are watched instead of loaded once."""
