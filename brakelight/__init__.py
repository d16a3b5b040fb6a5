"""brakelight: complaint-corpus cleaning, vector retrieval and evaluation on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; nothing in the library collects data to the driver.
"""

__version__ = "0.1.0"
