"""docsift: document preparation, retrieval and question answering as Spark plans."""

__version__ = "0.1.0"
