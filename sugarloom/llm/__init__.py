"""Training-data operators: scoring, joining, filtering, labelling and mixing of text corpora."""
