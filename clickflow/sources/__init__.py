"""Input scans, decoders and the test-table adapter."""
