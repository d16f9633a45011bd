"""loomspark: Spark jobs for the data work around language models.

Every public operator takes and returns DataFrames.  Nothing here runs a model:
logits, embeddings and activations come in as tables or from a user function.
"""

__version__ = "0.1.0"
