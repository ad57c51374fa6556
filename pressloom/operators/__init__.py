"""Relational operators over page, link, site and article tables."""
