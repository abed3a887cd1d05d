"""Deliveries as a stream."""
