"""Registered queries, their SQL counterparts and end-to-end workflows."""
