"""Finance analytics on Spark DataFrames: operators, sources and end-to-end plans."""

from ledgerloom.session import apply_scale_settings, build_session
from ledgerloom.sources.warehouse import Warehouse

__all__ = ["Warehouse", "apply_scale_settings", "build_session"]
