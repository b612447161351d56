"""Where input tables come from and where the history is kept."""
