"""Operators of a training-data pipeline (near duplicates, tokenisers, filters,
personal data, packing, page extraction).  Nothing outside this subpackage,
``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py`` uses it."""
