"""Live-room and app-event analytics as Spark DataFrame jobs."""
