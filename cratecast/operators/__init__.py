"""cratecast.operators."""
