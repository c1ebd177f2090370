"""callcorpus: function-calling corpus preparation and scoring as Spark jobs.

Subpackages
-----------
functions  Column -> Column building blocks (Python-compatible JSON text, text helpers).
operators  DataFrame -> DataFrame operators (formatters, splits, scoring, validation, table queries).
sources    readers and writers (JSONL cases, catalogs, registries, split sinks, report sinks).
plans      end-to-end batch jobs and the driver-facing query registry.
streaming  Structured Streaming forms of the row-local and aggregate operators.
"""

__version__ = "0.1.0"
