"""Operators for preparing training text: scans, rules, de-duplication, mixing, packing, search."""
