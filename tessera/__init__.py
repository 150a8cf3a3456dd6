"""tessera: the data jobs of a Spark recommender / feature / skew toolkit,
written as DataFrame, Spark SQL, Spark ML and Structured Streaming code.

Every operator takes DataFrames (or column names) and returns a DataFrame;
nothing here creates a session, collects a table or prints.
"""

__version__ = "0.1.0"
