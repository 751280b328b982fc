"""Complete queries over the standard tables, and the credit-default analysis."""
