"""Operators of a training-data pipeline.

The package stands alone: nothing else in the library imports it, so it can be
removed together with ``tests/llm`` and ``corpus_pipeline.py``.
"""
