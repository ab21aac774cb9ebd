"""Operators of a training-data pipeline; nothing else in scriptorium imports this subpackage."""
