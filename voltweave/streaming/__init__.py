"""The rules on streams."""
