"""cratecast.functions."""
