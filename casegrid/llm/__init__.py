"""Operators of a training-data pipeline: toxicity, deduplication, WARC
archives, decontamination, packing, fingerprints and personal data.

Nothing outside this subpackage imports it.
"""
