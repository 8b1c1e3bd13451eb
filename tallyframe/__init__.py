"""Retail data marts as Spark jobs: file intake, conform, star enrichment, marts, ledger."""
