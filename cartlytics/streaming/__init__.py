"""Streaming entry points.

The reference loads its tables once and has no streams, watermarks or
stateful operators (SURVEY §2.11), so nothing here adds an operator: the
typed CSV load (S1) is offered as a file stream, so the same declared
schemas apply to files that keep arriving in a folder.
"""
