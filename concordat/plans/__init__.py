"""Named datasets composed from the operators, and the checked queries."""
