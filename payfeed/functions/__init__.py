"""Column rules shared by the feeds and the payloads."""
