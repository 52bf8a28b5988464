"""Micro-batch ingestion."""
