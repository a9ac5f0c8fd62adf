"""tessera: Spark-native data-engineering operators.

Every operator takes and returns DataFrames (or is a Spark ML stage).
Nothing is collected to the driver except bounded results such as
per-column statistics or model coefficients.
"""

__version__ = "0.1.0"
