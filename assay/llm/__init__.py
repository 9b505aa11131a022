"""Operators for preparing training text: mixing, deduplication, classification, rules and packing."""
