"""Readers and writers: tables, archive, brand lines, exports, logs."""
