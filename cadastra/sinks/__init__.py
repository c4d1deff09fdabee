"""Sinks: documents, shards, manifests and digests."""
