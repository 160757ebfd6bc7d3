"""Reading landed data and writing result tables."""
