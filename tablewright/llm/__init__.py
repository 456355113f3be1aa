"""Operators for preparing text corpora: chat formatting, near and exact
deduplication, quality rules, scoring, licences, mixing and tokenising.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""
