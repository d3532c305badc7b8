"""DataFrame operators that work on any table."""
