"""functions of the terrain and road library."""
