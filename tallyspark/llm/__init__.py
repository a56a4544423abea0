"""Operators for preparing training text and linking records; nothing else in the package imports this one."""
