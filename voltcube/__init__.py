"""voltcube: star-schema analytics on Spark.

Cleans long and wide indicator tables, builds conformed dimensions and
facts, and answers drill-across questions in two forms (native OLAP
operators and their UNION ALL / join emulation).
"""

__version__ = "0.1.0"
