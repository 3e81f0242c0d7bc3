"""ledgerline: layered (bronze -> silver -> gold) transaction analytics on Spark.

Every transformation is a plain ``DataFrame -> DataFrame`` function; I/O lives
in :mod:`ledgerline.sources` and :mod:`ledgerline.sinks`, end-to-end jobs in
:mod:`ledgerline.plans`, the incremental variant in :mod:`ledgerline.streaming`.
"""

from ledgerline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
__version__ = "0.1.0"
