"""Reading landed data, writing it, and message feeds."""
