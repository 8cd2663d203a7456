"""quayside: visit-presence and retail-basket analytics on Spark DataFrames.

Subpackages:

* ``sources``   - readers and writers (CSV, legacy encodings, ordered record files, Parquet)
* ``functions`` - scalar ``Column -> Column`` helpers (text, time)
* ``operators`` - ``DataFrame -> DataFrame`` building blocks (filters, corrections, joins,
  aggregates, ordered windows, reshaping)
* ``plans``     - the composite queries and cleaning pipelines, and the query catalog
* ``llm``       - operators for preparing language-model training text (optional)

``python -m quayside --help`` runs the pipelines and the analytics on files (``cli.py``).
"""

__version__ = "0.1.0"
