"""corpuskit: text-corpus preparation, retrieval and evaluation as Spark plans."""
