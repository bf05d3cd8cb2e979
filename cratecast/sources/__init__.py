"""cratecast.sources."""
