"""The named output models, as DataFrame -> DataFrame functions."""
