"""seqflow: keyed, ordered sensor-sequence analytics as Spark DataFrame operators.

Every operator is a lazy `DataFrame -> DataFrame` function (usable with
`DataFrame.transform`) built on Spark SQL expressions and window functions.
"""

__version__ = "0.1.0"
