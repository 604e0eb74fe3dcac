"""quirelake: document-structure analytics over PySpark DataFrames."""

__version__ = "0.1.0"
