"""Subpackage of scriptorium; see README.md."""
