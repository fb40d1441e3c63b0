"""corpusflow: a Spark-native engine for building and analysing web-text corpora.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``
built from Spark SQL expressions; Python workers are used only for HTML parsing
and pluggable external annotators.
"""

from corpusflow.session import get_spark, load_table, checkpoint_dir

__all__ = ["get_spark", "load_table", "checkpoint_dir"]
