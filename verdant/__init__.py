"""verdant: Spark-native sensor analytics.

A library of DataFrame operators (``verdant.operators``), readers and writers
(``verdant.sources``, ``verdant.sinks``), column functions
(``verdant.functions``), batch plans (``verdant.plans``) and Structured
Streaming jobs (``verdant.streaming``) for facility sensor readings: landing,
typing, quality checks, temperature/humidity band joins, 30-minute climate
facts and keyed serving tables.
"""

__version__ = "0.1.0"
