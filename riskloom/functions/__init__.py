from riskloom.functions.columns import *  # noqa: F401,F403
from riskloom.functions.names import *  # noqa: F401,F403
