"""revline: review analytics on Spark.

Every transform is a ``DataFrame -> DataFrame`` function; nothing is
collected to the driver except scalars (bounds, counts) that decide a plan.
"""

__version__ = "0.1.0"
