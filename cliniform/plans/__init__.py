"""One plan per target table."""
