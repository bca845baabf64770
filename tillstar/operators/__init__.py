"""DataFrame operators shared by the warehouse layers."""
