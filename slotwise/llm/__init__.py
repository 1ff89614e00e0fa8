"""Training-data operators: deduplication, scans, mixing, quality, packing, extraction, sharding.

Nothing outside this folder imports it, except ``__spark_entry__.py`` and
``corpus_pipeline.py``. ``queries.py`` registers the ``opN_<name>`` queries.

Rules shared by all operators here

* columns are named by parameters; every other column of the input is either
  ignored or carried through untouched, whatever its name;
* intermediate tables are Parquet under the shared folder (``spark.checkpoint.dir``),
  so a lost executor re-reads them and never recomputes a different answer.
"""
