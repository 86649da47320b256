"""DataFrame -> DataFrame operators (R1-R18 and their building blocks)."""
