"""The concrete market warehouse, composed from the generic operators."""
