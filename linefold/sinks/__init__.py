"""Durable outputs: the per-batch ledger and the catalog summary table."""
