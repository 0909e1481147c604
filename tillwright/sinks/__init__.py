"""Writers that can be run again without changing the result."""
