"""Operators for preparing training text: scoring, scanning, de-duplication, packing and token files."""
