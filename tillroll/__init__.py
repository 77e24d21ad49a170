"""tillroll: a Spark-native batch engine for retail invoice-line analytics.

Every operator is a function from DataFrame(s) to a DataFrame built only from
``pyspark.sql`` built-ins, so Catalyst plans it and adaptive execution tunes
it at run time. Nothing is collected to the driver except scalar answers and
small metadata.
"""

from tillroll.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
