"""The lending pipeline, wired from the operators."""
