"""Warehouse loads and marts."""
