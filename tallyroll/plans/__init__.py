"""The metrics and the runs that compute, publish and load them."""
