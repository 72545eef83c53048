"""Table contracts, readers, writers and the artifact catalog."""
