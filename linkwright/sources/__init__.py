"""Readers and writers of the tab-separated contract."""
