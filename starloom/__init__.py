"""Dimensional-warehouse operators for Spark DataFrames.

``functions``  column expressions (no DataFrame needed)
``operators``  DataFrame -> DataFrame building blocks: cleaning, keys, joins, merges, quality, statistics
``sources``    files, JSON payloads, versioned table store, replication
``plans``      whole warehouse loads and reporting marts composed from the operators
``streaming``  the same loads as Structured Streaming micro-batches
"""
