"""Readers: dated snapshots, files, catalogue tables and limit sheets."""
