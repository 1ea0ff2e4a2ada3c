"""framelake: video-frame and fiducial-marker analytics on PySpark."""
