"""What surrounds a release on disk: receipts, assembly, locks, promotion, cards and publication."""
