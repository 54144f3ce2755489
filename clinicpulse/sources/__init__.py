"""Reading exports and databases, and keeping state tables."""
