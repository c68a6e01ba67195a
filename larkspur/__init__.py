"""Analytics jobs expressed as Spark DataFrames.

Every public function takes DataFrames (or a session and a path) and returns a
DataFrame; nothing is brought to the driver except results whose size is bounded
by a parameter.
"""

from larkspur.session import build_session, stable, stored

__all__ = ["build_session", "stable", "stored"]
