"""netscope: network-measurement analytics expressed as Spark DataFrame plans.

Sub-packages
------------
- ``sources``   : scans (JSON experiment files, generic JSON, Parquet, CSV, listings, footers)
- ``functions`` : pure ``Column`` expressions (casts, pairs, labels, calendar parts, ...)
- ``operators`` : DataFrame -> DataFrame operators (cleaning, profiling, series, outliers, models, ...)
- ``plans``     : stand-in views over the driver tables and the registered query catalog
- ``streaming`` : the ingest transform run as an incremental file stream
"""

__version__ = "0.1.0"
