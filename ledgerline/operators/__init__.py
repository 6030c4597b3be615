"""Ledger operators: validation, versions, measures, reconciliation, summaries, quality, reader, operations."""
