"""Readers, column contracts, the test-table adapter and shared storage."""
