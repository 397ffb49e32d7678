from tidewater.streaming.pipelines import *  # noqa: F401,F403
