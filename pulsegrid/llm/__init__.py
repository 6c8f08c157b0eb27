"""Operators for preparing training data: token packing, search, near-duplicates and the like.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames,
keeps rows whole and never gathers an unbounded group in one task or in the driver.
"""
