from .trip_columns import *  # noqa: F401,F403
