"""Extension: recordings that are still being written, as a stream."""
