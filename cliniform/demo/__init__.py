"""Source tables derived from the star-schema test data."""
