"""hirelens: job-posting analytics as Spark DataFrame operators.

Every operator is either ``Column -> Column`` (``hirelens.functions``) or
``DataFrame -> DataFrame`` (``hirelens.operators``); batch and Structured
Streaming share the same builders and field names.
"""

from hirelens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
