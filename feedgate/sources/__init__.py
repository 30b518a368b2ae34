"""Readers for deliveries and the token graph, and the inventory of what arrived."""
