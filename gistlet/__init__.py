"""gistlet: extractive summarization of text corpora as Spark jobs.

Sub-packages
------------
sources    readers and writers (JSONL, parquet, whole-text files, model store)
functions  column expressions (text rules, quantization) and small per-row helpers
operators  DataFrame operators (vocabulary, encoding, scoring, top-k, ROUGE, training)
plans      the registered queries and their DuckDB twins
streaming  Structured Streaming summarization
"""

__version__ = "0.1.0"
