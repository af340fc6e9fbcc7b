"""Operators for preparing training data: near copies, formatting, mixing, counting, filtering, packing and search."""
