"""Publishing, receipts, dead letters, printed lines and table snapshots."""
