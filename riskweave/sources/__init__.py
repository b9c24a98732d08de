"""Scans of the shared tables and the views that bind them to risk schemas."""
