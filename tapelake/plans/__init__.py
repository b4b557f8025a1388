"""The layers, end to end."""
