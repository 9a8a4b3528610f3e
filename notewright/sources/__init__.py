from .tables import read_table, spread

__all__ = ["read_table", "spread"]
