"""Operators for preparing training data: search, deduplication, scans, mixing and sharding.

One module per operator; ``queries`` registers them.  Nothing outside this
package (and ``corpus_pipeline.py``) imports it.
"""
