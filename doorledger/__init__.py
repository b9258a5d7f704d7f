"""Access-event analytics on Spark: logs, alerts, embeddings, features, metrics."""

from doorledger.session import configure, get_session, scratch_dir

__all__ = ["configure", "get_session", "scratch_dir"]
