"""Operators that prepare a text corpus for training language models.

Nothing outside this subpackage imports it; it imports nothing from the rest of the library.
"""
