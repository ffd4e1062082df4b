"""Column-expression helpers (all built-in Spark functions, JVM side)."""

from hazardline.functions.timefn import *  # noqa: F401,F403
from hazardline.functions.keys import *  # noqa: F401,F403
