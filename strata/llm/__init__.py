"""Training-data operators: ten operators over documents, embeddings, pages and conversations."""
