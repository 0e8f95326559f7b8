"""Analytics over annotated conversation corpora, as Spark DataFrame and SQL plans."""
