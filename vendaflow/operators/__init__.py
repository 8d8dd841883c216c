"""DataFrame operators that build the star schema."""
