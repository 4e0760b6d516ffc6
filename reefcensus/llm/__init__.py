"""Corpus operators for training data: deduplication, token counting and
storage, quality rules, mixing, decontamination, scoring and secret scans.

Every operator is ``DataFrame -> DataFrame`` over a table with at least
``doc_id`` and ``text``; other columns may be present and may clash with
names used inside, since each operator selects what it needs first.
"""
