"""Operators for preparing large text collections: ten numbered operators and their queries."""
