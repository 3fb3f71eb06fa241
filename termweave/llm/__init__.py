"""Training-data operators on documents, embeddings and conversations."""
