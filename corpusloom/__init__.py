"""corpusloom: building, curating and querying evidence corpora with Spark DataFrames."""

__version__ = "0.1.0"
