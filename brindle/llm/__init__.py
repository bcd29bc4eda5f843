"""Operators on text and records for training data; nothing else in brindle imports this subpackage."""
