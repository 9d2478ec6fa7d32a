"""End-to-end workflows composed from the operators."""
