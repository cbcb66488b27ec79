"""The registered queries in plain SQL for an independent engine."""
