"""Equivalent SQL for every registered query, used only for checking."""
