"""ledgerlark: a Spark-native transaction pipeline and review-ranking engine.

Layout:
  sources/    line scans, file fingerprints, the driver-table adapter, the versioned store
  functions/  column expressions (contract checks, payload, hashes, display text)
  operators/  DataFrame -> DataFrame operators (classify, promote, risk, reconcile, ...)
  plans/      stateful workflows built from operators (ingest, promote, publish, model)
  streaming/  Structured Streaming landing-zone ingestion
"""

__version__ = "0.1.0"
