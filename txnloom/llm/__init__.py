"""Operators for preparing training text: quality, mixing, toxicity, search, duplicates, tokens, privacy.

Each module holds one operator. ``queries`` registers one query per operator. Nothing outside this
folder (and ``corpus_pipeline``) imports it.
"""
