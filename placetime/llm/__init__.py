"""Operators that prepare training data: each module is one operator over document or page tables."""
