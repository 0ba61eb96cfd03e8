"""Readers for the tables, vendor exports, manifests and text formats, and the writers beside them."""
