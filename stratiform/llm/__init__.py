"""Training-data operators (quality, URL rules, licences, near copies, packing, ...).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
