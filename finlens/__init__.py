"""finlens — Spark-native tabular regression analytics.

Parameterised DataFrame operators that take one flat table from raw file to an
explained prediction: profiling, cleaning, feature preparation, regression,
evaluation, attribution and batch / streaming scoring.  Every operator works on
a ``pyspark.sql.DataFrame`` and a :class:`finlens.spec.Spec` that names the
column roles; nothing is hard-coded to one data set.
"""

from finlens.spec import Spec

__all__ = ["Spec"]
__version__ = "0.1.0"
