"""docnorm — normalise nested document collections into relational tables with Spark.

Layers:
  functions/  Column -> Column expressions over VARIANT values (truthiness, guards,
              timestamps, ids, JSON forms).
  operators/  DataFrame -> DataFrame operators: row generators (explode, unions,
              unpivots, dynamic fields), referential integrity (semi/anti joins,
              ghost parents), key-conflict policies, profiling aggregates,
              post-load validation.
  sources/    reading documents (JSON lines / JSON arrays -> VARIANT), samples,
              table writers, and nesting of relational tables into documents.
  plans/      declarative collection specs (tables, columns, keys, FKs, policies)
              and the load orchestration built on them.
  streaming/  the same normalisation applied per micro-batch of a file stream.
"""
__version__ = "0.1.0"
