"""Reading raw resources and writing tables."""
