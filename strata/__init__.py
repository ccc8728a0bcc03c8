"""strata — layered (bronze → silver → gold → warehouse) incident analytics on Spark.

Every transform is a lazy ``DataFrame -> DataFrame`` function built from the public
DataFrame / Structured Streaming API. Actions happen only in the sinks
(``strata.sources.lake.write_table``), in the incremental loaders and in callers.
"""

from strata.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
