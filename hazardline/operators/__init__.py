"""Domain operators as DataFrame -> DataFrame functions."""
