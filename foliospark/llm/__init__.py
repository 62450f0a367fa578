"""Operators for training data from texts and images; nothing outside imports this subpackage."""
