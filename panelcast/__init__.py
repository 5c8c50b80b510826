"""panelcast: weekly demand models on Spark DataFrames.

Sub-packages: ``sources`` (scans, stores, sinks, fixture views), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame operators),
``plans`` (jobs composed of operators) and ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
