"""End-to-end preparations, composed from the operators."""
