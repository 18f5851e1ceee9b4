"""Registered queries over the demo tables and the SQL that states their expected results."""
