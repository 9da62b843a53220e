"""Training-data operators: language ID, dedup, tokens, search, packing, extraction.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it; the
operators only use general helpers of the library (session, checkpoint folder).
"""
