"""Readers and writers: tables, queue messages, archive files, blobs."""
