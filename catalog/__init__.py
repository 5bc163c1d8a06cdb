"""Registered queries and the SQL that checks each of them."""
