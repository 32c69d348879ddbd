"""pagemill: preparing text corpora for document-recognition and language-model training, on Spark."""

__version__ = "0.1.0"
