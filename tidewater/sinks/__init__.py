from tidewater.sinks.writers import *  # noqa: F401,F403
