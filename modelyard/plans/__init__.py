"""End-to-end jobs assembled from operators, sources and sinks."""
