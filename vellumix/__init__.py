"""vellumix: a PySpark-native engine for scanned and transcribed archive collections.

Subpackages: ``sources`` (readers), ``functions`` (Column expressions), ``operators`` (DataFrame -> DataFrame),
``plans`` (registered queries with their SQL), ``streaming`` (incremental variants) and the optional ``llm``.
"""

__version__ = "0.1.0"
