"""Views and whole jobs composed from the operators."""
