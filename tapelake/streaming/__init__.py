"""New tapes as they land."""
