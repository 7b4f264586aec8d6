"""Stored pipelines made of the operators."""
