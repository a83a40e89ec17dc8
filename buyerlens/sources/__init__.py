"""Readers for topics, files, databases and word lists."""
