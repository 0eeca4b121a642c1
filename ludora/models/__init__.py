"""Recommenders (RC-*): each scores candidate rows for all users at once."""
