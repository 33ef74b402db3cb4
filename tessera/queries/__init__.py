"""Every operator as a query."""
