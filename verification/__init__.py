"""Every operator as a query over the test tables, next to independent SQL for the same result."""
