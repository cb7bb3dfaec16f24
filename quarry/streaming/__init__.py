"""Structured Streaming operators: append log, audit of login requests, incremental
embeddings and the pet event replay.  All are exactly-once through checkpoints in the
shared checkpoint folder; tests drive them with ``trigger(availableNow=True)``."""
