"""Readers and writers: tab-separated files, web pages, documents, batches."""
