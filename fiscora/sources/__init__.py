"""Readers and writers: Bronze text, watermark state, audit log, Gold table."""
