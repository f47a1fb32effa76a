"""Relational operators and feature families."""
