"""Operators for training-data pipelines: one module per operator.

Nothing outside this folder imports it (only ``__spark_entry__.py`` registers
its queries, and ``corpus_pipeline.py`` chains five of the operators).
"""
