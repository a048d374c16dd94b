"""Loading deliveries as they arrive."""
