"""Readers and writers: files, landed API pages, documents, web pages, stored tables."""
