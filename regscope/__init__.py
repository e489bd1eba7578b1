"""regscope: registry reports on Spark.

Sources (``regscope.sources``) read landed CSV/Parquet tables; ``regscope.functions``
holds column expressions; ``regscope.operators`` the DataFrame building blocks;
``regscope.plans`` the reports and end-to-end passes; ``regscope.streaming`` the
incremental landing job; ``regscope.sinks`` the writers.
"""

__version__ = "0.1.0"
