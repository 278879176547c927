"""DataFrame-to-DataFrame operators of the procurement model."""
