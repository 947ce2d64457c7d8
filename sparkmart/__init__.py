"""sparkmart: a real-time e-commerce warehouse written for PySpark.

Raw application logs and database changes become cleaned facts and dimensions,
wide facts, and windowed subject statistics.  Every transformation is a plain
``DataFrame -> DataFrame`` function; the same function runs in batch and in
Structured Streaming unless its docstring says otherwise.
"""
