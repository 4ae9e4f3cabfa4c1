from .semantics import *  # noqa: F401,F403
