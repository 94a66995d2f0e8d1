"""folioscan: lexical retrieval and evidence-based question answering over long documents, on Spark."""

__version__ = "0.1.0"
