"""corpusloom: DataFrame-first analytics over large text corpora on Spark."""
