"""Live metrics, sessions, running scores and alarms over event streams."""
