"""Readers and writers: tables, relational databases, committed batches, the lake, text files."""
