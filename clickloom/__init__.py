"""Click-through-rate features, sampling, scoring and analysis as Spark DataFrame jobs.

``functions``  column expressions: no shuffle, no state, usable on any DataFrame
``operators``  transformations that aggregate, join, rank or train
``plans``      whole recipes and batch jobs composed from the operators
``sources``    readers, writers and the adapters that derive impressions from the test tables
"""

__version__ = "0.1.0"
