"""Operators for training-data preparation (deduplication, filtering, mixing, packaging).

Nothing outside this subpackage imports it. Every operator works on any DataFrame that holds
the columns it names; other columns are ignored, whatever they are called.
"""
