"""End-to-end runs assembled from the operators."""
