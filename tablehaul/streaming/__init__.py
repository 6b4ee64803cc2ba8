"""Line streams through external commands and Python callables, per partition."""
