"""Claims, membership and outreach analytics expressed as Spark DataFrame functions."""

from tidewell.params import RunParams
from tidewell.session import build_session, tune

__all__ = ["RunParams", "build_session", "tune"]
