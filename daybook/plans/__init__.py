"""Whole jobs: audited and concurrent loads, the attendance refreshes."""
