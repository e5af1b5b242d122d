"""tidemark: event analytics on Spark DataFrames.

Every operator is a function ``DataFrame (+ parameters) -> DataFrame``. Order-sensitive
operators take an explicit ordering (``order``) and a ``split`` (a monotone slice of that
ordering, usually a time bucket) so that one hot key is processed by many tasks.
"""

__version__ = "0.1.0"
