"""Operators for text corpora: language, copies, packing, tokens, quality, licences, pages."""
