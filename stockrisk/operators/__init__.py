"""DataFrame -> DataFrame operators of the inventory-risk models."""
