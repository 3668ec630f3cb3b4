"""Readers and writers: documents, manifests, checksums, table sinks."""
