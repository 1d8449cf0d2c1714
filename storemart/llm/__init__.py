"""Training-data operators over the corpus tables (documents, pages, benchmark, conversations)."""
