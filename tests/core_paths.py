"""Paths that the core tests share (a name of its own: other test folders have a conftest, too)."""

SF = "/root/testdata/sf0.001"
