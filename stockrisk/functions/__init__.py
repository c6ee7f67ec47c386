"""Column expressions of the inventory-risk models."""
