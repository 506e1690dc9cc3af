"""Types and scalar conversions."""
