"""Operators for building training corpora: filtering, deduplication, labelling, archiving, search and packing.

Nothing else in the library imports this subpackage.
"""
