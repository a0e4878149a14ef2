"""Column functions: packed text, dates, numbers, places."""

from .text import *  # noqa: F401,F403
from .values import *  # noqa: F401,F403
