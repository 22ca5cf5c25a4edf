"""Column helpers (scalar functions X1-X22); all build JVM-side expressions."""

from ridemart.functions.scalar import *  # noqa: F401,F403
from ridemart.functions.scalar import __all__  # noqa: F401
