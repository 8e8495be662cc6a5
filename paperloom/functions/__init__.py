"""Column functions: no actions, no joins, usable in any select or filter."""
