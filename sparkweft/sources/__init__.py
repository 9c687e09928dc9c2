"""Readers for pages, artefacts, robots files and sitemaps."""
