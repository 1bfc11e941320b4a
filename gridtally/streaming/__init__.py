"""Files that arrive while a run is under way."""
