from tidewater.functions.columns import *  # noqa: F401,F403
from tidewater.functions.registry import HandlerRegistry, square, square_pandas  # noqa: F401
