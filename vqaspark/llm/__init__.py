"""Training-data pipeline operators (language-model scoring, tokenizing,
neighbour search, cleaning, mixing and de-duplication of text corpora)."""
