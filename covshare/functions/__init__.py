"""Column functions: geographic keys and arithmetic."""
