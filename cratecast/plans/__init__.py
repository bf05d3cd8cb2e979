"""cratecast.plans."""
