"""shoplens: customer-activity analytics as lazy Spark DataFrame operators.

Sub-packages
------------
functions   column-expression helpers (date arithmetic, encodings, ratios)
operators   DataFrame -> DataFrame operators (cleaning, quality checks,
            features, RFM, exploration, ranking, metrics, business tables)
sources     readers and writers (CSV, Parquet, JDBC, report/model sinks)
plans       adapters from the driver's tables and the registered queries
ml          Spark ML training, tuning, overfit checks and batch scoring
streaming   continuous scoring with Structured Streaming
"""

__version__ = "0.1.0"
