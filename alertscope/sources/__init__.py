"""Inputs: topic/file/table adapters, page bodies and the test-table mapping."""
