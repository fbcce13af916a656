"""Registered queries over stand-in views, with the SQL that must agree."""
