"""End-to-end jobs (capture, detection) and the registered fixture queries."""
