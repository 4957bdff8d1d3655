"""corpusflow: document-corpus ingestion and search as Spark DataFrame jobs.

functions/  Column expressions (paths, hashing, text, vectors)
sources/    listing, ledgers, markdown store, collections
operators/  chunking, dedup, embedding, points, filters, search, text index, reports, conversion
plans/      fixtures, whole jobs, the registered query catalog
streaming/  Structured Streaming ingest and monitoring
"""

__version__ = "0.1.0"
