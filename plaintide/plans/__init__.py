"""Models, marts, serving frames and whole runs."""
