"""Operators of a training-data pipeline (packing, near-duplicates, language
models, token files). Each module holds one operator; ``queries`` registers the
``opN_<name>`` queries. Nothing outside this package imports it, except the
guarded registration in ``__spark_entry__``."""
