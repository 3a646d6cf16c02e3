"""Incremental (high-water-mark) loading and appending."""
