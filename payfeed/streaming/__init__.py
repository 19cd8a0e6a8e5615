"""The same feeds over arriving files."""
