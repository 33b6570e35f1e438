"""Incremental, checkpointed runs."""
