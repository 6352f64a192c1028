"""Streaming: incremental landing of arriving files into bronze.

The reference's acquisitions are batch full refreshes; the same landing
can run as an ``availableNow`` file stream so newly arrived files are
picked up once each, with exactly-once output through the checkpoint.
"""
