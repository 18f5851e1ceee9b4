"""Operators for preparing training corpora: search, scoring, filtering, packing and mixing."""
