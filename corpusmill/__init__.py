"""corpusmill: corpus preparation and measurement as Spark DataFrame operators.

Every public operator is a plain function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, aggregates, joins and windows; Python runs inside tasks
only where Spark has no built-in (Unicode normalisation, lenient UTF-8 decode,
subword segmentation).
"""

__version__ = "0.1.0"
