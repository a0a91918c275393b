"""quarry — document retrieval tables on Spark.

Every operator is a ``DataFrame -> DataFrame`` function.  Modules:

* ``quarry.config``      fixed parameters and table schemas
* ``quarry.session``     session / checkpoint-dir helpers
* ``quarry.functions``   column expressions (text, paths, hashing, vectors)
* ``quarry.sources``     file listings, text files, sections, queries, driver-table roles
* ``quarry.operators``   chunking, vectors, similarity top-k, index, ledger, prompts, ingest
* ``quarry.streaming``   incremental ingest and streaming retrieval
* ``quarry.plans``       the registered query catalogue and its DuckDB oracle SQL
"""

__version__ = "0.1.0"
