"""Report specifications, the loads they drive, and the marts on top."""
