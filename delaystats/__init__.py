"""delaystats: keyed fact-table analytics as plain Spark DataFrame jobs."""

from delaystats.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
