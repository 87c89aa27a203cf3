"""Column expressions (F1-F12, P3-P4, P9-P14). All are JVM-side built-ins."""

from .exprs import *  # noqa: F401,F403
