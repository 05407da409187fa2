"""Raw inputs and stored tables."""
