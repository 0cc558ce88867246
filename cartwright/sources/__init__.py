"""Table contracts, readers, sinks and the mapping from the test tables to the commerce schema."""
