"""foliomill: a Spark-first engine for document corpora."""
