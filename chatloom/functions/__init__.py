"""Subpackage of chatloom."""
