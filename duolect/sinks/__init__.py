"""Dataset table, error ledger, summaries and per-sample export."""
