"""The operators and queries of this package, run on the supplied tables."""
