"""Readers, writers, the file catalogue and restartable runs."""
